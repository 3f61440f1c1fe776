"""Expressions of the query language -> columns."""

from __future__ import annotations

import re
from typing import TYPE_CHECKING

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import values as V
from tessera.functions.schema_check import conforms
from tessera.functions.values import NULL, VARIANT, QueryError, Val
from tessera.plans import ast as A

if TYPE_CHECKING:
    from collections.abc import Mapping

BOOL, STRING = T.BooleanType(), T.StringType()


class Expressions:
    """Compiles expressions over an environment of variables. Subqueries and aggregates have been lifted before."""

    def __init__(self, env: Mapping[str, Val], globals_: Mapping[str, Val], strict: bool = True):
        self.env, self.globals, self.strict = env, globals_, strict

    def value(self, e: A.Node) -> Val:
        match e:
            case A.Const(v):
                return V.constant(v)
            case A.Var(name):
                if name not in self.env:
                    raise QueryError(f"unknown variable {name}")
                return self.env[name]
            case A.Global(name):
                if name not in self.globals:
                    raise QueryError(f"unknown variable @{name}")
                return self.globals[name]
            case A.Star():
                return V.struct({k: self.env[k] for k in sorted(self.env) if not k.startswith("$")})
            case A.Object(parts):
                return self.object(parts)
            case A.Array(parts):
                return self.array(parts)
            case A.Template(literals, parts):
                out = [F.lit(literals[0])]
                for e_, literal in zip(parts, literals[1:]):
                    out += [V.as_string(self.value(e_), self.strict, "template"), F.lit(literal)]
                return Val(F.concat(*out), STRING)
            case A.Property(s, name):
                return self.property(self.value(s), name)
            case A.Element(s, i):
                return self.element(self.value(s), self.value(i), i)
            case A.Call(s, method, args):
                return self.call(self.value(s), method, [self.value(a) for a in args], args)
            case A.Binary("+", a, b):
                return self.add(self.value(a), self.value(b))
            case A.Binary("and", a, b):
                left, right = self.value(a), self.value(b)
                (l, r), t = V.unify(left, right)
                return Val(F.when(self.test(a), r).otherwise(l), t)
            case A.Binary("or", a, b):
                left, right = self.value(a), self.value(b)
                (l, r), t = V.unify(left, right)
                return Val(F.when(self.test(a), l).otherwise(r), t)
            case A.Binary(("==" | "!="), _, _) | A.Not(_) | A.Valid(_, _, _):
                return Val(self.test(e), BOOL)
            case A.Case(subject, whens, otherwise):
                return self.case(subject, whens, otherwise)
        raise QueryError(f"can't evaluate {type(e).__name__} here")

    def test(self, e: A.Node) -> Column:
        """The truth of an expression."""
        match e:
            case A.Binary("and", a, b):
                # the right side may fail where the left side is false
                return self.test(a) & self.test(b) if _harmless(b) else F.when(self.test(a), self.test(b)).otherwise(False)
            case A.Binary("or", a, b):
                return self.test(a) | self.test(b)
            case A.Binary("==", a, b):
                return V.equal(self.value(a), self.value(b))
            case A.Binary("!=", a, b):
                return ~V.equal(self.value(a), self.value(b))
            case A.Not(a):
                return ~self.test(a)
            case A.Valid(s, schema, negated):
                ok = conforms(V.text_key(self.value(s)), V.text_key(self.value(schema)))
                return ~ok if negated else ok
            case A.Call(s, "match", args) if len(args) == 1:
                subject = V.as_string(self.value(s), self.strict, "match")
                if isinstance(args[0], A.Const) and isinstance(args[0].value, str):
                    return F.coalesce(subject.rlike(V.java_regex(args[0].value)), F.lit(False))
                pattern = F.concat(F.lit("(?dU)"), F.regexp_replace(V.as_string(self.value(args[0]), self.strict, "match"), r"\(\?P<", "(?<"))
                return F.coalesce(F.rlike(subject, pattern), F.lit(False))
        return V.truthy(self.value(e))

    def object(self, parts: tuple) -> Val:
        known: dict[str, Val] = {}
        steps: list = []  # maps to concatenate if a spread isn't static
        dynamic = False
        for key, e in parts:
            v = self.value(e)
            if key is not None:
                known.pop(key, None)
                known[key] = v
                steps.append(V.struct({key: v}))
            elif isinstance(v.type, T.StructType):
                for k, x in V.struct_parts(v).items():
                    known.pop(k, None)
                    known[k] = x
                steps.append(v)
            elif v.dynamic or isinstance(v.type, T.MapType):
                dynamic = True
                steps.append(v)
            elif not isinstance(v.type, T.NullType):
                raise QueryError(f"... of {v.type.simpleString()} in an object")
        if not dynamic:
            return V.struct(known)
        return Val(F.to_variant_object(F.map_concat(*[V.map_of(s) for s in steps]) if len(steps) > 1 else V.map_of(steps[0])), VARIANT)

    def array(self, parts: tuple) -> Val:
        vals = [(spread, self.value(e)) for spread, e in parts]
        if not vals:
            return V.constant([])
        types = []
        for spread, v in vals:
            if spread and isinstance(v.type, T.ArrayType):
                types.append(v.type.elementType)
            elif spread and not v.dynamic:
                raise QueryError(f"... of {v.type.simpleString()} in an array")
            else:
                types.append(v.type)
        t = V.common_type(types)
        pieces, run = [], []
        for spread, v in vals:
            if not spread:
                run.append(V.coerce(v, t))
                continue
            if run:
                pieces.append(F.array(*run))
                run = []
            if v.dynamic:
                pieces.append(V.as_array(v))
            elif isinstance(t, T.VariantType):
                pieces.append(_dynamic_elements(v))
            else:
                pieces.append(v.col.cast(T.ArrayType(t)))
        if run:
            pieces.append(F.array(*run))
        col = F.concat(*pieces) if len(pieces) > 1 else pieces[0]
        return Val(F.to_variant_object(col), VARIANT) if isinstance(t, T.VariantType) else Val(col, T.ArrayType(t))

    def missing(self, col: Column, what: str) -> Column:
        return F.coalesce(col, F.raise_error(F.lit(what)).cast("variant")) if self.strict else F.coalesce(col, V.variant_null())

    def property(self, v: Val, name: str) -> Val:
        if (f := V.field(v, name)) is not None:
            return f
        if v.dynamic:
            return Val(self.missing(F.try_variant_get(F.when(V.is_object(v.col), v.col), f"$.{name}", "variant"), f"no key {name}"), VARIANT)
        if isinstance(v.type, T.MapType):
            return Val(F.element_at(v.col, F.lit(name)) if self.strict else F.try_element_at(v.col, F.lit(name)), v.type.valueType)
        if self.strict:
            raise QueryError(f"no key {name} in {v.type.simpleString()}")
        return V.constant(None)

    def element(self, v: Val, i: Val, e: A.Node) -> Val:
        number = isinstance(i.type, V.NUMERIC)
        if isinstance(v.type, T.ArrayType):
            at = F.when(i.col >= 0, i.col + 1).otherwise(i.col).cast("int") if not isinstance(e, A.Const) else F.lit(e.value + 1 if e.value >= 0 else e.value)
            return Val(F.element_at(v.col, at) if self.strict else F.try_element_at(v.col, at), v.type.elementType)
        if isinstance(v.type, T.StringType) and number:
            at = F.when(i.col >= 0, i.col + 1).otherwise(i.col).cast("int")
            c = F.substr(v.col, at, F.lit(1))
            return Val(F.when(F.length(c) == 1, c).otherwise(V._fail("no such character") if self.strict else F.lit(None)), STRING)
        if isinstance(v.type, T.StructType) and isinstance(e, A.Const) and isinstance(e.value, str):
            return self.property(v, e.value)
        if isinstance(v.type, T.MapType):
            return Val(F.element_at(v.col, i.col) if self.strict else F.try_element_at(v.col, i.col), v.type.valueType)
        if isinstance(v.type, T.StructType) and not number and v.type.fields:
            cols, t = V.unify(*V.struct_parts(v).values())
            if not isinstance(t, T.VariantType | T.NullType):
                entries = F.create_map(*[x for k, c in zip(v.type.names, cols) for x in (F.lit(k), c)])
                key = V.as_string(i, self.strict, "element")
                found = F.try_element_at(entries, key)
                there = F.coalesce(key.isin(*v.type.names), F.lit(False))
                return Val(F.when(there, found).otherwise(F.raise_error(F.lit("no such key")).cast(t)) if self.strict else found, t)
        if v.dynamic or isinstance(v.type, T.StructType):
            d = Val(V.to_variant(v), VARIANT)
            if number:
                at = F.when(i.col >= 0, i.col + 1).otherwise(i.col).cast("int")
                return Val(self.missing(F.try_element_at(V.as_array(d), at), "no such element"), VARIANT)
            key = V.as_string(i, self.strict, "element")
            return Val(self.missing(V.entry(d, key), "no such key"), VARIANT)
        raise QueryError(f"no elements in {v.type.simpleString()}")

    def add(self, a: Val, b: Val) -> Val:
        if isinstance(a.type, V.NUMERIC) and isinstance(b.type, V.NUMERIC):
            t = V.common_type([a.type, b.type])
            return Val(V.coerce(a, t) + V.coerce(b, t), t)
        if isinstance(a.type, T.StringType) and isinstance(b.type, T.StringType):
            return Val(F.concat(a.col, b.col), STRING)
        if isinstance(a.type, T.ArrayType) and isinstance(b.type, T.ArrayType):
            (x, y), t = V.unify(a, b)
            if isinstance(t, T.VariantType):
                return Val(F.to_variant_object(F.concat(V.as_array(Val(x, VARIANT)), V.as_array(Val(y, VARIANT)))), VARIANT)
            return Val(F.concat(x, y), t)
        if isinstance(a.type, T.StringType) or isinstance(b.type, T.StringType):
            return Val(F.concat(V.as_string(a, self.strict, "+"), V.as_string(b, self.strict, "+")), STRING)
        if a.dynamic or b.dynamic:
            x, y = Val(V.to_variant(a), VARIANT), Val(V.to_variant(b), VARIANT)
            both = lambda test: test(x.col) & test(y.col)
            number = lambda c: V.kind(c).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
            whole = lambda c: V.kind(c) == "BIGINT"
            get = lambda v, t: F.try_variant_get(v.col, "$", t)
            out = (
                F.when(both(lambda c: V.kind(c) == "STRING"), V.to_variant(Val(F.concat(get(x, "string"), get(y, "string")), STRING)))
                .when(both(V.is_array), F.to_variant_object(F.concat(V.as_array(x), V.as_array(y))))
                .when(both(whole), (get(x, "bigint") + get(y, "bigint")).cast("variant"))
                .when(both(number), (get(x, "double") + get(y, "double")).cast("variant"))
            )
            return Val(out.otherwise(F.raise_error(F.lit("+: values of different kinds")).cast("variant") if self.strict else V.variant_null()), VARIANT)
        raise QueryError(f"{a.type.simpleString()} + {b.type.simpleString()}")

    def case(self, subject: A.Node | None, whens: tuple, otherwise: A.Node | None) -> Val:
        results = [self.value(r) for _, r in whens] + [self.value(otherwise) if otherwise else V.constant(None)]
        cols, t = V.unify(*results)
        if not whens:
            return Val(cols[-1], t)
        s = self.value(subject) if subject else None
        out = None
        for (condition, _), c in zip(whens, cols):
            test = self.test(condition) if s is None else V.equal(s, self.value(condition))
            out = F.when(test, c) if out is None else out.when(test, c)
        return Val(out.otherwise(cols[-1]), t)

    def call(self, s: Val, method: str, args: list[Val], nodes: tuple) -> Val:
        f = getattr(self, f"m_{method}", None)
        if f is None:
            raise QueryError(f"unknown method {method}")
        return f(s, args, nodes)

    def m_replace(self, s: Val, args: list[Val], nodes: tuple) -> Val:
        text = V.as_string(s, self.strict, "replace")
        a, b = (V.as_string(x, self.strict, "replace") for x in args[:2])
        if len(args) > 2:
            triple = F.array(text, a, b, args[2].col.cast("string"))
            run = V.apply_text(lambda t: t[0].replace(t[1], t[2], int(t[3])) if all(x is not None for x in t) else None, STRING)
            return Val(run(triple), STRING)
        between = F.concat(b, F.array_join(F.transform(_chars(text), lambda c: F.concat(c, b)), ""))
        if isinstance(nodes[0], A.Const):
            return Val(F.replace(text, a, b) if nodes[0].value else between, STRING)
        return Val(F.when(a == "", between).otherwise(F.replace(text, a, b)), STRING)

    def m_split(self, s: Val, args: list[Val], nodes: tuple) -> Val:
        text = V.as_string(s, self.strict, "split")
        out = T.ArrayType(STRING)
        if not args:
            return Val(F.array(text), out)
        sep = V.as_string(args[0], self.strict, "split")
        limit = F.when(args[1].col >= 0, args[1].col + 1).otherwise(-1).cast("int") if len(args) > 1 else F.lit(-1)
        if isinstance(nodes[0], A.Const):
            if nodes[0].value == "":
                return Val(_chars(text), out)
            return Val(F.split(text, F.lit(V.quoted(nodes[0].value)), limit), out)
        quoted = F.concat(F.lit("\\Q"), F.replace(sep, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
        return Val(F.when(sep == "", _chars(text)).otherwise(F.split(text, quoted, limit)), out)

    def m_join(self, s: Val, args: list[Val], nodes: tuple) -> Val:
        sep = V.as_string(args[0], self.strict, "join") if args else F.lit(",")
        if isinstance(s.type, T.StringType):
            items = _chars(s.col)
        elif isinstance(s.type, T.ArrayType):
            items = s.col.cast("array<string>") if not isinstance(s.type.elementType, T.VariantType) else F.transform(s.col, lambda x: F.variant_get(x, "$", "string"))
        elif s.dynamic:
            items = F.coalesce(F.transform(V.as_array(s), lambda x: F.variant_get(x, "$", "string")), _chars(F.try_variant_get(s.col, "$", "string")))
        else:
            raise QueryError(f"join of {s.type.simpleString()}")
        joined = F.aggregate(items, F.lit(None).cast("string"), lambda acc, x: F.coalesce(F.concat(acc, sep, x), x))
        if self.strict:  # an element that is no string is an error
            joined = F.when(F.exists(items, lambda x: x.isNull()), V._fail("join: not a string")).otherwise(joined)
        return Val(F.when(items.isNotNull(), F.coalesce(joined, F.lit(""))), STRING)

    def m_includes(self, s: Val, args: list[Val], nodes: tuple) -> Val:
        x = args[0]
        if isinstance(s.type, T.StringType):
            return Val(F.coalesce(F.contains(s.col, V.as_string(x, self.strict, "includes")), F.lit(False)), BOOL)
        if isinstance(s.type, T.ArrayType):
            element = s.type.elementType
            if isinstance(element, T.NullType):
                return Val(F.lit(False), BOOL)
            if isinstance(nodes[0], A.Const) and x.type.simpleString() == element.simpleString() and nodes[0].value is not None:
                return Val(F.coalesce(F.array_contains(s.col, x.col), F.lit(False)), BOOL)
            return Val(F.coalesce(F.exists(s.col, lambda e: V.equal(Val(e, element), x)), F.lit(False)), BOOL)
        if isinstance(s.type, T.StructType):
            return Val(V.as_string(x, self.strict, "includes").isin(*s.type.names) if s.type.names else F.lit(False), BOOL)
        if isinstance(s.type, T.MapType):
            return Val(F.coalesce(F.map_contains_key(s.col, x.col), F.lit(False)), BOOL)
        if s.dynamic:
            text = V.as_string(x, False, "includes") if x.dynamic or isinstance(x.type, T.StringType | T.NullType) else F.lit(None).cast("string")
            out = (
                F.when(V.kind(s.col) == "STRING", F.contains(F.try_variant_get(s.col, "$", "string"), text))
                .when(V.is_array(s.col), F.exists(V.as_array(s), lambda e: V.equal(Val(e, VARIANT), x)))
                .when(V.is_object(s.col), F.map_contains_key(V.as_map(s), F.coalesce(text, F.lit(""))))
            )
            return Val(F.coalesce(out, F.lit(False)), BOOL)
        raise QueryError(f"includes of {s.type.simpleString()}")

    def m_trim(self, s: Val, args: list[Val], nodes: tuple) -> Val:
        return Val(F.regexp_replace(V.as_string(s, self.strict, "trim"), r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", ""), STRING)

    def m_match(self, s: Val, args: list[Val], nodes: tuple) -> Val:
        """[whole, *groups] of the first match, null for none; a group that took no part is null."""
        pair = F.array(V.as_string(s, self.strict, "match"), V.as_string(args[0], self.strict, "match"))
        run = V.apply_text(_groups, T.ArrayType(STRING))
        return Val(run(pair), T.ArrayType(STRING))


def _groups(pair) -> list[str | None] | None:  # noqa: ANN001
    if pair[0] is None or pair[1] is None:
        return None
    m = re.search(pair[1], pair[0])
    return [m.group(), *m.groups()] if m else None


def _dynamic_elements(v: Val) -> Column:
    return F.transform(v.col, lambda x: V.to_variant(Val(x, v.type.elementType)))


def _chars(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.filter(F.split(text, ""), lambda c: c != ""))


def _harmless(e: A.Node) -> bool:
    """Whether an expression can't fail at run time: then a conjunction may be reordered and pushed down."""
    if isinstance(e, A.Call | A.Element | A.Property | A.Template) or (isinstance(e, A.Binary) and e.op == "+"):
        return isinstance(e, A.Call) and e.method in ("includes", "match", "trim") and isinstance(e.subject, A.Var) and all(isinstance(a, A.Const) for a in e.args)
    return all(map(_harmless, A.children(e)))
