"""Reverse templates: a template of the usual kind is turned into a parser from HTML to nested documents.

A template is compiled into a small program that a backtracking machine runs with an explicit stack of alternatives, so
neither long lists nor long texts deepen a call stack. What is known of each variable is a domain: a value, or values
that it can't have. A branch first assumes one way after another in which its condition holds. A capture jumps straight
to the places where what must follow it can begin.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass


class TemplateError(ValueError):
    """A template that isn't supported."""


# -- syntax

_PART = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<string>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<number>-?\d+(?:\.\d+)?)|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|[|(),.\[\]]))""")


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Literal:
    text: str


@dataclass(frozen=True)
class Capture:
    path: str
    filter: str | None = None
    args: tuple = ()


@dataclass(frozen=True)
class Loop:
    item: str
    items: str
    body: tuple


@dataclass(frozen=True)
class Branch:
    condition: tuple
    body: tuple
    other: tuple


def _lex(text: str) -> list[tuple[str, object]]:
    out, i = [], 0
    text = text.strip()
    while i < len(text):
        m = _TOKEN.match(text, i)
        if not m:
            raise TemplateError(f"can't read {text[i:]!r}")
        kind = m.lastgroup
        s = m.group(kind)
        if kind == "string":
            s = re.sub(r"\\(.)", lambda x: {"n": "\n", "t": "\t", "r": "\r"}.get(x.group(1), x.group(1)), s[1:-1])
        out.append((kind, (float(s) if "." in s else int(s)) if kind == "number" else s))
        i = m.end()
    return [*out, ("end", None)]


class _Expression:
    """Reads the inside of {{ }} and {% %}."""

    def __init__(self, text: str):
        self.toks, self.i = _lex(text), 0

    def now(self) -> tuple[str, object]:
        return self.toks[self.i]

    def accept(self, kind: str, value: object = None) -> object:
        k, v = self.now()
        if k == kind and (value is None or v == value):
            self.i += 1
            return v if v is not None else True
        return None

    def expect(self, kind: str, value: object = None) -> object:
        got = self.accept(kind, value)
        if got is None:
            raise TemplateError(f"expected {value or kind}, found {self.now()[1]!r}")
        return got

    def done(self) -> None:
        self.expect("end")

    def path(self) -> str:
        parts = [str(self.expect("name"))]
        while self.accept("mark", "."):
            parts.append(str(self.expect("name")))
        return ".".join(parts)

    def constant(self) -> object:
        kind, v = self.now()
        if kind in ("string", "number"):
            self.i += 1
            return v
        if self.accept("mark", "["):
            items = []
            while not self.accept("mark", "]"):
                items.append(self.constant())
                self.accept("mark", ",")
            return tuple(items)
        word = str(self.expect("name")).lower()
        if word not in ("none", "true", "false"):
            raise TemplateError(f"{word} is no constant")
        return {"none": None, "true": True, "false": False}[word]

    def output(self) -> object:
        kind, v = self.now()
        if kind in ("string", "number"):
            self.i += 1
            self.done()
            return Literal(str(v))
        path = self.path()
        if not self.accept("mark", "|"):
            self.done()
            return Capture(path)
        name, args = str(self.expect("name")), []
        if self.accept("mark", "("):
            while not self.accept("mark", ")"):
                args.append(self.constant())
                self.accept("mark", ",")
        self.done()
        if name not in ("safe", "replace", "join"):
            raise TemplateError(f"filter {name} isn't supported")
        return Capture(path, name, tuple(args))

    # conditions: ("is", path, value) | ("true", path) | ("not", c) | ("and", a, b) | ("or", a, b)

    def condition(self) -> tuple:
        left = self._and()
        while self.accept("name", "or"):
            left = ("or", left, self._and())
        return left

    def _and(self) -> tuple:
        left = self._not()
        while self.accept("name", "and"):
            left = ("and", left, self._not())
        return left

    def _not(self) -> tuple:
        if self.accept("name", "not"):
            return ("not", self._not())
        if self.accept("mark", "("):
            c = self.condition()
            self.expect("mark", ")")
            return c
        path = self.path()
        if self.accept("mark", "=="):
            return ("is", path, self.constant())
        if self.accept("mark", "!="):
            return ("not", ("is", path, self.constant()))
        if self.accept("name", "is"):
            negated = self.accept("name", "not") is not None
            if str(self.expect("name")).lower() != "none":
                raise TemplateError("only the test none is supported")
            return ("not", ("is", path, None)) if negated else ("is", path, None)
        return ("true", path)


def parse_template(source: str) -> tuple:
    parts: list[tuple[str, str]] = []
    at = 0
    for m in _PART.finditer(source):
        parts.append(("text", source[at : m.start()]))
        parts.append(("out", m.group(1)) if m.group(1) is not None else ("tag", m.group(2).strip()) if m.group(2) is not None else ("text", ""))
        at = m.end()
    parts.append(("text", source[at:]))
    parts = [p for p in parts if p != ("text", "")]
    nodes, i = _nodes(parts, 0, ())
    if i < len(parts):
        raise TemplateError(f"unexpected {parts[i][1]}")
    return nodes


def _nodes(parts: list, i: int, until: tuple[str, ...]) -> tuple[tuple, int]:
    out = []
    while i < len(parts):
        kind, text = parts[i]
        if kind == "text":
            out.append(Text(text))
            i += 1
            continue
        if kind == "out":
            out.append(_Expression(text).output())
            i += 1
            continue
        word = text.split(None, 1)[0] if text else ""
        if word in until:
            return tuple(out), i
        rest = text[len(word) :]
        if word == "for":
            e = _Expression(rest)
            item = e.path()
            e.expect("name", "in")
            items = e.path()
            e.done()
            body, i = _nodes(parts, i + 1, ("endfor",))
            _end(parts, i, "endfor")
            out.append(Loop(item, items, body))
            i += 1
        elif word == "if":
            node, i = _branch(parts, i, rest)
            out.append(node)
        else:
            raise TemplateError(f"tag {word} isn't supported")
    if until:
        raise TemplateError(f"expected {' or '.join(until)}")
    return tuple(out), i


def _branch(parts: list, i: int, condition: str) -> tuple[Branch, int]:
    e = _Expression(condition)
    c = e.condition()
    e.done()
    body, i = _nodes(parts, i + 1, ("elif", "else", "endif"))
    tag = parts[i][1]
    if tag.split(None, 1)[0] == "elif":
        # the rest of the chain is the other branch
        other, i = _branch(parts, i, tag[4:])
        return Branch(c, body, (other,)), i
    if tag == "else":
        rest, i = _nodes(parts, i + 1, ("endif",))
        _end(parts, i, "endif")
        return Branch(c, body, rest), i + 1
    return Branch(c, body, (Literal(""),)), i + 1


def _end(parts: list, i: int, word: str) -> None:
    if i >= len(parts) or parts[i][1] != word:
        raise TemplateError(f"expected {word}")


# -- domains


@dataclass(frozen=True)
class Other:
    """Any value but these."""

    values: tuple


def _equal(a: object, b: object) -> bool:
    return a == b and isinstance(a, bool) == isinstance(b, bool)


def meet(a: object, b: object) -> tuple[bool, object]:
    """Whether two domains have a value in common, and what they have."""
    if isinstance(a, Other) and isinstance(b, Other):
        return True, Other((*a.values, *[v for v in b.values if v not in a.values]))
    if isinstance(a, Other):
        return not any(_equal(b, v) for v in a.values), b
    if isinstance(b, Other):
        return not any(_equal(a, v) for v in b.values), a
    return _equal(a, b), a


def join(store: dict, more: dict) -> dict | None:
    """The store with more assumptions, None if they contradict it."""
    out = store
    for k, v in more.items():
        if k in out:
            ok, both = meet(out[k], v)
            if not ok:
                return None
            if both is out[k]:
                continue
            v = both
        if out is store:
            out = dict(store)
        out[k] = v
    return out


def solutions(c: tuple, truth: bool) -> Iterator[dict]:
    """Each set of assumptions under which a condition is true, or false."""
    match c:
        case ("true", path):
            yield {path: truth}
        case ("is", path, value):
            yield {path: value if truth else Other((value,))}
        case ("not", inner):
            yield from solutions(inner, not truth)
        case ((("and" | "or") as op), a, b):
            for x in (True, False):
                for y in (True, False):
                    if ((x and y) if op == "and" else (x or y)) == truth:
                        for s in solutions(a, x):
                            for t in solutions(b, y):
                                if (both := join(s, t)) is not None:
                                    yield both


# -- the machine


def markup_regex(text: str) -> str:
    """Text of a template as a pattern: white space is one with any white space, and is free around tags and ends."""
    s = re.sub(r"\s*([<>])\s*", r"\1", text.strip())
    words = [re.sub(r"[<>]", lambda m: rf"\s*{m.group()}\s*", re.escape(w)) for w in s.split()]
    return r"\s*" + r"\s+".join(words) + r"\s*"


class Program:
    """Instructions: (operation, operands...). Alternatives are tried in the order in which they are pushed last."""

    def __init__(self, nodes: tuple):
        self.code: list[tuple] = []
        self._emit(nodes)
        self.code.append(("end",))
        self.ahead = [self._ahead(pc + 1) if op[0] == "take" else None for pc, op in enumerate(self.code)]

    def _emit(self, nodes: tuple) -> None:
        for n in nodes:
            match n:
                case Text(text):
                    self.code.append(("skip", re.compile(markup_regex(text), re.I), text.strip()))
                case Literal(text):
                    self.code.append(("skip", re.compile(re.escape(text)), text))
                case Capture(path, name, args):
                    self.code.append(("take", path, "" if name == "safe" else "<>", _reading(name, args)))
                case Loop(item, items, body):
                    self.code.append(("assume", ({items: ()},)))
                    start = len(self.code)
                    self.code.append(("loop", None))
                    self._emit(body)
                    self.code.append(("item", item, items, start))
                    self.code[start] = ("loop", len(self.code))
                case Branch(condition, body, other):
                    fork = len(self.code)
                    self.code.append(("fork", None))
                    self.code.append(("assume", condition, True))
                    self._emit(body)
                    jump = len(self.code)
                    self.code.append(("jump", None))
                    self.code[fork] = ("fork", len(self.code))
                    self.code.append(("assume", condition, False))
                    self._emit(other)
                    self.code[jump] = ("jump", len(self.code))

    def _ahead(self, pc: int) -> re.Pattern | None:
        """What can begin after a capture, as one pattern; None if anything can."""
        found: list[str] = []
        flags: set[int] = set()

        def walk(pc: int, depth: int) -> bool:
            if depth > 40:
                return False
            op = self.code[pc]
            match op[0]:
                case "skip":
                    if op[1].pattern in ("", r"\s*\s*"):
                        return walk(pc + 1, depth + 1)
                    found.append(f"(?i:{op[1].pattern})" if op[1].flags & re.I else op[1].pattern)
                    return True
                case "end":
                    found.append(r"\Z")
                    return True
                case "assume":
                    return walk(pc + 1, depth + 1)
                case "jump":
                    return walk(op[1], depth + 1)
                case "fork" | "loop":
                    return walk(pc + 1, depth + 1) and walk(op[1], depth + 1)
                case "item":
                    return walk(op[3], depth + 1)
            return False

        return re.compile("|".join(dict.fromkeys(found))) if walk(pc, 0) and found and not flags else None


def _reading(name: str | None, args: tuple) -> Callable[[str], object]:
    if name == "safe":
        return lambda s: s
    if name == "replace":
        return lambda s: html_entities.unescape(s).replace(args[1], args[0])
    if name == "join":
        sep = args[0] if args else ""
        return lambda s: tuple(html_entities.unescape(s).split(sep)) if sep else tuple(html_entities.unescape(s))
    return html_entities.unescape


def _nested(store: dict, prefix: str = "") -> object:
    """The values below a name as nested documents, keys in order; what was only assumed not to be is left out."""
    if prefix and prefix in store:
        v = store[prefix]
        return None if isinstance(v, Other) else v
    out: dict = {}
    start = prefix + "." if prefix else ""
    for k in sorted(store):
        if k.startswith(start) and not isinstance(store[k], Other):
            at = out
            *path, last = k[len(start) :].split(".")
            for p in path:
                at = at.setdefault(p, {})
            at[last] = store[k]
    return out


@dataclass(frozen=True, eq=False)
class Chain:
    """A list that a loop has collected so far: alternatives share what came before."""

    before: Chain | None
    value: object

    def items(self) -> list:
        out, at = [], self
        while at is not None:
            out.append(at.value)
            at = at.before
        return out[::-1]


def _plain(v: object) -> object:
    if isinstance(v, Chain):
        v = v.items()
    if isinstance(v, tuple | list):
        return [_plain(x) for x in v]
    return {k: _plain(x) for k, x in v.items()} if isinstance(v, dict) else v


class Template:
    """A compiled template; calling it with a text gives (True, document) or (False, what was expected where).

    max_tries: failures after which the parser gives up.
    """

    def __init__(self, source: str, max_tries: int | None = None):
        self.program = Program(parse_template(source))
        self.max_tries = max_tries

    def __call__(self, text: str) -> tuple[bool, object]:
        code, ahead = self.program.code, self.program.ahead
        far, expected, tries = 0, set(), 0
        # alternatives: (pc, position, store, memory of the instruction)
        stack: list[tuple] = [(0, 0, {}, None)]

        def fail(at: int, what: str) -> bool:
            nonlocal far, tries
            if at > far:
                far = at
                expected.clear()
            if at == far:
                expected.add(what)
            tries += 1
            return self.max_tries is not None and tries > self.max_tries + 1

        while stack:
            pc, pos, store, memory = stack.pop()
            while True:
                op = code[pc]
                kind = op[0]
                if kind == "skip":
                    m = op[1].match(text, pos)
                    if not m:
                        if fail(pos, repr(op[2])):
                            stack.clear()
                        break
                    pos = m.end()
                    pc += 1
                elif kind == "take":
                    _, path, stop, read = op
                    start, n = memory if memory else (pos, pos)
                    memory = None
                    limit = self._limit(text, start, stop)
                    at = n
                    if ahead[pc] is not None and self.max_tries is None:
                        m = ahead[pc].search(text, n)
                        if m is None or m.start() > limit:
                            # nothing that may follow begins in reach: the capture fails at its end
                            at = limit
                    else:
                        m = None
                    if m is not None and m.start() <= limit:
                        at = m.start()
                    done = at >= limit
                    value = read(text[start:at])
                    new = join(store, {path: value})
                    if not done:
                        stack.append((pc, start, store, (start, at + 1)))
                    if new is None:
                        if done and fail(start, repr(_plain(store[path]) if not isinstance(store[path], Other) else value)):
                            stack.clear()
                        break
                    store, pos = new, at
                    pc += 1
                elif kind == "assume":
                    ways = memory if memory is not None else iter(op[1]) if len(op) == 2 else solutions(op[1], op[2])
                    memory = None
                    way = next(ways, None)
                    if way is None:
                        break
                    stack.append((pc, pos, store, ways))
                    new = join(store, way)
                    if new is None:
                        if fail(pos, repr("(constraint)")):
                            stack.clear()
                        break
                    store = new
                    pc += 1
                elif kind == "fork":
                    stack.append((op[1], pos, store, None))
                    pc += 1
                elif kind == "jump":
                    pc = op[1]
                elif kind == "loop":
                    stack.append((op[1], pos, store, None))
                    store = {**store, f"\0{pc}": pos}
                    pc += 1
                elif kind == "item":
                    _, item, items, start_pc = op
                    if store.get(f"\0{start_pc}") == pos:
                        break  # a round that takes nothing would go on for ever
                    value = _nested({k: v for k, v in store.items() if k[0] != "\0"}, item)
                    seen = store.get(items)
                    store = {k: v for k, v in store.items() if k != item and not k.startswith(item + ".") and k != f"\0{start_pc}"}
                    store[items] = Chain(seen if isinstance(seen, Chain) else None, value)
                    pc = start_pc
                else:  # end
                    if pos == len(text):
                        return True, _plain(_nested({k: v for k, v in store.items() if k[0] != "\0"}))
                    if fail(pos, "end of file"):
                        stack.clear()
                    break
        before = text[:far].split("\n")
        return False, f"Expected {', '.join(sorted(expected))} at {len(before)}:{len(before[-1]) + 1}"

    @staticmethod
    def _limit(text: str, start: int, stop: str) -> int:
        if not stop:
            return len(text)
        ends = [i for c in stop if (i := text.find(c, start)) >= 0]
        return min(ends, default=len(text))


def load_template(source: str, max_tries: int | None = None) -> Template:
    return Template(source, max_tries)


def untemplate(template_path: str, source_path: str, encoding: str | None = None, max_tries: int | None = None) -> object:
    """The document of a file; an error if it doesn't parse."""
    with open(template_path, encoding="utf-8") as f:
        template = Template(f.read(), max_tries)
    with open(source_path, encoding=encoding) as f:
        ok, result = template(f.read())
    if not ok:
        raise ValueError(result)
    return result
