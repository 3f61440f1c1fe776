"""Syntax tree of the pattern-query language."""

from __future__ import annotations

from dataclasses import dataclass, field


class Node:
    pass


# Patterns: what a value is taken apart by.


@dataclass(frozen=True)
class PConst(Node):
    value: object  # a string, number, None or []


@dataclass(frozen=True)
class PVar(Node):
    path: tuple[str, ...]


@dataclass(frozen=True)
class PGlobal(Node):
    name: str


@dataclass(frozen=True)
class PPair(Node):
    key: str
    pattern: Node
    default: PConst | None = None


@dataclass(frozen=True)
class PObject(Node):
    pairs: tuple[PPair, ...]
    rest: Node | None = None


@dataclass(frozen=True)
class PTuple(Node):
    elements: tuple[Node, ...]
    rest: Node | None = None


@dataclass(frozen=True)
class PTemplate(Node):
    literals: tuple[str, ...]
    patterns: tuple[Node, ...]


@dataclass(frozen=True)
class PAlias(Node):
    pattern: Node
    name: str


@dataclass(frozen=True)
class PUnwind(Node):
    pattern: Node


@dataclass(frozen=True)
class PUnpack(Node):
    key: Node
    value: Node


# Expressions.


@dataclass(frozen=True)
class Const(Node):
    value: object


@dataclass(frozen=True)
class Var(Node):
    name: str


@dataclass(frozen=True)
class Global(Node):
    name: str


@dataclass(frozen=True)
class Star(Node):
    pass


@dataclass(frozen=True)
class Object(Node):
    parts: tuple[tuple[str | None, Node], ...]  # key None: spread


@dataclass(frozen=True)
class Array(Node):
    parts: tuple[tuple[bool, Node], ...]  # True: spread


@dataclass(frozen=True)
class Template(Node):
    literals: tuple[str, ...]
    parts: tuple[Node, ...]


@dataclass(frozen=True)
class Property(Node):
    subject: Node
    name: str


@dataclass(frozen=True)
class Element(Node):
    subject: Node
    index: Node


@dataclass(frozen=True)
class Call(Node):
    subject: Node
    method: str
    args: tuple[Node, ...]


@dataclass(frozen=True)
class Aggregate(Node):
    inner: Node


@dataclass(frozen=True)
class Binary(Node):
    op: str  # and, or, ==, !=, +
    left: Node
    right: Node


@dataclass(frozen=True)
class Not(Node):
    inner: Node


@dataclass(frozen=True)
class Valid(Node):
    subject: Node
    schema: Node
    negated: bool


@dataclass(frozen=True)
class Case(Node):
    subject: Node | None
    whens: tuple[tuple[Node, Node], ...]
    otherwise: Node | None


@dataclass(frozen=True)
class Exists(Node):
    query: Query


@dataclass(frozen=True)
class ArrayOf(Node):
    query: Query


# Clauses and statements.


@dataclass(frozen=True)
class Load(Node):
    format: str
    path: Node
    pattern: Node


@dataclass(frozen=True)
class Match(Node):
    pattern: Node


@dataclass(frozen=True)
class With(Node):
    pairs: tuple[tuple[Node, Node | None], ...]  # (expression, pattern); None: the variable itself, or all for *


@dataclass(frozen=True)
class Set(Node):
    target: PVar | PGlobal
    value: Node


@dataclass(frozen=True)
class Where(Node):
    condition: Node


@dataclass(frozen=True)
class OrderBy(Node):
    key: Node


@dataclass(frozen=True)
class Create(Node):
    value: Node


@dataclass(frozen=True)
class Return(Node):
    value: Node
    distinct: bool = False


@dataclass(frozen=True)
class Merge(Node):
    patch: Node
    pattern: Node


@dataclass(frozen=True)
class Delete(Node):
    pattern: Node


@dataclass(frozen=True)
class Save(Node):
    format: str
    value: Node
    path: Node


@dataclass(frozen=True)
class Query(Node):
    reads: tuple[Node, ...]
    write: Node | None = None


@dataclass(frozen=True)
class Union(Node):
    left: Node
    right: Node


@dataclass(frozen=True)
class CreateIndex(Node):
    name: str
    pattern: Node


@dataclass(frozen=True)
class DropIndex(Node):
    name: str


@dataclass
class Script(Node):
    statements: list[Node] = field(default_factory=list)


def children(node: Node) -> list[Node]:
    """The direct sub-nodes of an expression (not into subqueries)."""
    match node:
        case Object(parts):
            return [e for _, e in parts]
        case Array(parts):
            return [e for _, e in parts]
        case Template(_, parts):
            return list(parts)
        case Property(s, _):
            return [s]
        case Element(s, i):
            return [s, i]
        case Call(s, _, args):
            return [s, *args]
        case Aggregate(e) | Not(e):
            return [e]
        case Binary(_, a, b):
            return [a, b]
        case Valid(s, schema, _):
            return [s, schema]
        case Case(s, whens, other):
            return [*([s] if s else []), *(e for w in whens for e in w), *([other] if other else [])]
    return []


def rebuild(node: Node, f) -> Node:  # noqa: ANN001
    """The expression with f applied to each direct sub-node."""
    match node:
        case Object(parts):
            return Object(tuple((k, f(e)) for k, e in parts))
        case Array(parts):
            return Array(tuple((s, f(e)) for s, e in parts))
        case Template(literals, parts):
            return Template(literals, tuple(map(f, parts)))
        case Property(s, n):
            return Property(f(s), n)
        case Element(s, i):
            return Element(f(s), f(i))
        case Call(s, m, args):
            return Call(f(s), m, tuple(map(f, args)))
        case Aggregate(e):
            return Aggregate(f(e))
        case Not(e):
            return Not(f(e))
        case Binary(op, a, b):
            return Binary(op, f(a), f(b))
        case Valid(s, schema, n):
            return Valid(f(s), f(schema), n)
        case Case(s, whens, other):
            return Case(f(s) if s else None, tuple((f(a), f(b)) for a, b in whens), f(other) if other else None)
    return node


def variables(node: Node) -> list[str]:
    """Names of the variables that an expression reads, in order of appearance."""
    if isinstance(node, Var):
        return [node.name]
    return list(dict.fromkeys(v for c in children(node) for v in variables(c)))


def pattern_variables(node: Node) -> list[str]:
    """First names of the variables that a pattern binds."""
    match node:
        case PVar(path):
            return [path[0]]
        case PAlias(p, name):
            return [*pattern_variables(p), name]
        case PUnwind(p):
            return pattern_variables(p)
        case PUnpack(k, v):
            return [*pattern_variables(k), *pattern_variables(v)]
        case PObject(pairs, rest):
            return [v for p in pairs for v in pattern_variables(p.pattern)] + (pattern_variables(rest) if rest else [])
        case PTuple(elements, rest):
            return [v for p in elements for v in pattern_variables(p)] + (pattern_variables(rest) if rest else [])
        case PTemplate(_, patterns):
            return [v for p in patterns for v in pattern_variables(p)]
    return []


def has(node: Node, kinds: tuple[type, ...]) -> bool:
    return isinstance(node, kinds) or any(has(c, kinds) for c in children(node))


def conjuncts(node: Node) -> list[Node]:
    if isinstance(node, Binary) and node.op == "and":
        return [*conjuncts(node.left), *conjuncts(node.right)]
    return [node]
