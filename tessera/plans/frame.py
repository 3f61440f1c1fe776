"""A stream of contexts as a DataFrame, and the lowering of patterns onto it.

A frame holds a lazy DataFrame, the variables bound so far (name -> column expression with its type) and the columns by
which its rows are ordered. Binding a bound variable again is a filter: this one rule gives equality within a pattern,
natural joins, path selection and the conditions of MERGE and DELETE. Nothing runs here; filters, fan-out and binding
are expressions that the optimizer pushes into the scan.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import values as V
from tessera.functions.values import VARIANT, QueryError, Val
from tessera.plans import ast as A

_numbers = itertools.count()

#: Adjacent rows are compared within buckets of about so many rows, at most so many buckets; the cuts between them are
#: taken of so many values. Buckets are compared through their ends, in a table of at most RANGES rows.
BUCKET, RANGES, SAMPLED = 8_192, 16_384, 65_536


def fresh(prefix: str = "c") -> str:
    return f"__{prefix}{next(_numbers)}"


@dataclass(frozen=True)
class Frame:
    df: DataFrame
    env: dict[str, Val] = field(default_factory=dict)
    order: tuple[str, ...] = ()
    unit: bool = False  # one row without variables: the start of a statement

    def where(self, condition: Column) -> Frame:
        return replace(self, df=self.df.where(condition))

    def bind(self, name: str, v: Val) -> Frame:
        if name not in self.env:
            return replace(self, env={**self.env, name: v})
        old = self.env[name]
        out = self.where(V.compatible(old, v))
        if isinstance(old.type, T.NullType) or (isinstance(v.type, T.StructType | T.VariantType) and isinstance(old.type, T.StructType | T.VariantType)):
            out = replace(out, env={**out.env, name: V.merged(old, v)})
        return out

    def bind_path(self, path: tuple[str, ...], v: Val) -> Frame:
        if len(path) == 1:
            return self.bind(path[0], v)
        for part in reversed(path[1:]):
            v = V.struct({part: v})
        return self.bind(path[0], v)

    def flat(self, keep: list[str] | None = None) -> Frame:
        """The same with a plain column for each variable, under names that no other frame has."""
        names = {v: fresh("v") for v in (self.env if keep is None else keep)}
        order = {o: fresh("o") for o in self.order}
        cols = [F.col(o).alias(n) for o, n in order.items()] + [self.env[v].col.alias(n) for v, n in names.items()]
        if not cols:
            cols = [F.lit(True).alias(fresh("x"))]
        df = self.df.select(*cols)
        return Frame(df, {v: Val(F.col(n), self.env[v].type) for v, n in names.items()}, tuple(order.values()), self.unit)

    def explode(self, array: Column, element: T.DataType) -> tuple[Frame, Val]:
        """A row for each element; its position is the last of the order."""
        base = self.with_column(array)
        at, item = fresh("o"), fresh("e")
        df = base[0].df.select("*", F.posexplode(F.col(base[1])).alias(at, item)).withColumn(at, F.col(at).cast("long")).drop(base[1])
        return Frame(df, base[0].env, (*self.order, at)), Val(F.col(item), element)

    def with_column(self, c: Column) -> tuple[Frame, str]:
        n = fresh("t")
        f = replace(self, df=self.df.withColumn(n, c), unit=False)
        return f, n


def lower(pattern: A.Node, v: Val, frame: Frame) -> Frame:
    """The frame with the pattern's conditions, bindings and fan-out for the value."""
    match pattern:
        case A.PConst(value):
            return frame.where(is_constant(v, value))
        case A.PVar(path):
            return frame.bind_path(path, v)
        case A.PAlias(inner, name):
            return lower(inner, v, frame).bind(name, v)
        case A.PObject(pairs, rest):
            return _object(pairs, rest, v, frame)
        case A.PTuple(elements, rest):
            if rest is not None:
                raise QueryError("the rest of a tuple can't be bound")
            return _tuple(elements, v, frame)
        case A.PUnwind(inner):
            if isinstance(v.type, T.ArrayType):
                f, e = frame.explode(v.col, v.type.elementType)
            elif v.dynamic:
                f, e = frame.explode(V.as_array(v), VARIANT)
            else:
                return _never(inner, frame)
            return lower(inner, e, f)
        case A.PUnpack(key, value):
            return _unpack(key, value, v, frame)
        case A.PTemplate(literals, patterns):
            return _template(literals, patterns, v, frame)
    raise QueryError(f"{type(pattern).__name__} is no pattern here")


def is_constant(v: Val, value: object) -> Column:
    if value == []:
        if isinstance(v.type, T.ArrayType):
            return F.coalesce(F.size(v.col) == 0, F.lit(False))
        return F.coalesce(F.to_json(v.col) == "[]", F.lit(False)) if v.dynamic else F.lit(False)
    return V.equal(v, V.constant(value))


def _never(pattern: A.Node, frame: Frame) -> Frame:
    """No row; the pattern's variables are bound all the same, so that what follows can be compiled."""
    out = frame.where(F.lit(False))
    for name in A.pattern_variables(pattern):
        if name not in out.env:
            out = replace(out, env={**out.env, name: V.constant(None)})
    return out


def _object(pairs: tuple, rest: A.Node | None, v: Val, frame: Frame) -> Frame:
    whole = A.PObject(pairs, rest)
    keys = [p.key for p in pairs]
    if isinstance(v.type, T.StructType):
        f = frame.where(v.col.isNotNull())
        for p in pairs:
            inner = V.field(v, p.key)
            if inner is None and p.default is None:
                return _never(whole, frame)
            f = lower(p.pattern, inner if inner is not None else V.constant(p.default.value), f)
        if rest is not None:
            f = lower(rest, V.struct({k: x for k, x in V.struct_parts(v).items() if k not in keys}), f)
        return f
    if v.dynamic:
        obj = F.when(V.is_object(v.col), v.col)
        f = frame.where(V.is_object(v.col)) if not pairs or all(p.default is not None for p in pairs) else frame
        for p in pairs:
            inner = F.try_variant_get(v.col, f"$.{p.key}", "variant")
            if p.default is None:
                f = lower(p.pattern, Val(inner, VARIANT), f.where(inner.isNotNull()))
            else:
                f = lower(p.pattern, Val(F.coalesce(inner, V.to_variant(V.constant(p.default.value))), VARIANT), f)
        if rest is not None:
            left = F.map_filter(obj.cast("map<string,variant>"), lambda k, _: ~k.isin(*keys)) if keys else obj.cast("map<string,variant>")
            f = lower(rest, Val(F.to_variant_object(left), VARIANT), f)
        return f
    if isinstance(v.type, T.MapType):
        f = frame.where(v.col.isNotNull())
        for p in pairs:
            there = F.map_contains_key(v.col, F.lit(p.key))
            inner = Val(F.try_element_at(v.col, F.lit(p.key)), v.type.valueType)
            if p.default is None:
                f = lower(p.pattern, inner, f.where(there))
            else:
                (x, d), t = V.unify(inner, V.constant(p.default.value))
                f = lower(p.pattern, Val(F.when(there, x).otherwise(d), t), f)
        if rest is not None:
            f = lower(rest, Val(F.map_filter(v.col, lambda k, _: ~k.isin(*keys)) if keys else v.col, v.type), f)
        return f
    return _never(whole, frame)


def _tuple(elements: tuple, v: Val, frame: Frame) -> Frame:
    if isinstance(v.type, T.ArrayType):
        array, t = v.col, v.type.elementType
    elif v.dynamic:
        array, t = V.as_array(v), VARIANT
    else:
        return _never(A.PTuple(elements), frame)
    f = frame.where(F.coalesce(F.size(array) >= len(elements), F.lit(False)))
    for i, p in enumerate(elements):
        f = lower(p, Val(F.get(array, F.lit(i)), t), f)
    return f


def _unpack(key: A.Node, value: A.Node, v: Val, frame: Frame) -> Frame:
    bound = frame.env.get(key.path[0]) if isinstance(key, A.PVar) and len(key.path) == 1 else None
    if isinstance(v.type, T.StructType):
        parts = V.struct_parts(v)
        if not parts:
            return _never(A.PUnpack(key, value), frame)
        if isinstance(key, A.PConst) and key.value in parts:
            return lower(value, parts[key.value], frame.where(v.col.isNotNull()))
        cols, t = V.unify(*parts.values())
        entries = F.array(*[F.struct(F.lit(k).alias("k"), c.alias("v")) for k, c in zip(parts, cols)])
        f, e = frame.where(v.col.isNotNull()).explode(entries, T.StructType([T.StructField("k", T.StringType()), T.StructField("v", t)]))
        return lower(value, Val(e.col.getField("v"), t), lower(key, Val(e.col.getField("k"), T.StringType()), f))
    if v.dynamic:
        m, t = V.as_map(v), VARIANT
    elif isinstance(v.type, T.MapType):
        m, t = v.col, v.type.valueType
    else:
        return _never(A.PUnpack(key, value), frame)
    if bound is not None or isinstance(key, A.PConst):
        k = V.as_string(bound, False, "key") if bound is not None else F.lit(str(key.value))
        f = frame.where(F.coalesce(F.map_contains_key(m, F.coalesce(k, F.lit("\0"))), F.lit(False)))
        return lower(value, Val(F.try_element_at(m, k), t), f)
    f, e = frame.explode(F.map_entries(m), T.StructType([T.StructField("key", T.StringType()), T.StructField("value", t)]))
    return lower(value, Val(e.col.getField("value"), t), lower(key, Val(e.col.getField("key"), T.StringType()), f))


def template_regex(literals: tuple[str, ...]) -> str:
    """Anchored at the start and not at the end; each gap takes as much as it can of one line."""
    return "(?d)^" + "(.*)".join(map(V.quoted, literals))


def _template(literals: tuple, patterns: tuple, v: Val, frame: Frame) -> Frame:
    if not (v.dynamic or isinstance(v.type, T.StringType)):
        return _never(A.PTemplate(literals, patterns), frame)
    text = V.as_string(v, False, "template")
    regex = template_regex(literals)
    f = frame.where(F.coalesce(text.rlike(regex), F.lit(False)))
    for i, p in enumerate(patterns, 1):
        f = lower(p, Val(F.regexp_extract(text, regex, i), T.StringType()), f)
    return f


# -- joining, grouping


def natural_join(left: Frame, right: Frame, how: str = "inner") -> Frame:
    """All compatible pairs; shared variables are the condition. Without any it is the product, as the language says."""
    if left.unit:
        return right
    a, b = left.flat(), right.flat()
    shared = [n for n in a.env if n in b.env]
    condition = None
    for n in shared:
        c = join_condition(a.env[n], b.env[n])
        condition = c if condition is None else condition & c
    df = a.df.crossJoin(b.df) if condition is None else a.df.join(b.df, condition, how)
    env = {**a.env, **b.env}
    for n in shared:
        x, y = a.env[n], b.env[n]
        structs = all(isinstance(t.type, T.StructType | T.VariantType) for t in (x, y)) and not (x.dynamic and y.dynamic)
        env[n] = V.merged(x, y) if structs else x if not isinstance(x.type, T.NullType) else y
    return Frame(df, env, (*a.order, *b.order))


def join_condition(a: Val, b: Val) -> Column:
    """Compatibility as a hashable equality wherever the types allow one."""
    if a.dynamic and b.dynamic:
        return V.text_key(a) == V.text_key(b)
    return V.compatible(a, b)


def _bucketed(df: DataFrame, order: list[str], bucket: str) -> DataFrame:
    """df with the number of the range in which a row's place in the order falls. The cuts come from a bounded sample,
    one place for each of SAMPLED hashes: they only balance the buckets, any cuts give the same runs."""
    if not order:
        return df.withColumn(bucket, F.lit(0))
    place, h = F.struct(*order), F.xxhash64(*order)
    sample = df.groupBy(F.pmod(h, F.lit(SAMPLED))).agg(F.count("*").alias("n"), F.min_by(place, h).alias("x")).collect()
    wanted = min(RANGES, sum(r["n"] for r in sample) // BUCKET)
    places = sorted({tuple(r["x"]) for r in sample}, key=lambda x: [(v is not None, v) for v in x])
    cuts = places[:: max(1, len(places) // max(1, wanted))][1:]
    if wanted < 2 or not cuts:
        return df.withColumn(bucket, F.lit(0))
    types = [df.schema[o].dataType for o in order]
    literal = lambda x: F.struct(*[F.lit(v).cast(t).alias(o) for v, t, o in zip(x, types, order)])
    # two levels, so that a row is compared with about twice the root of the number of cuts
    width = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    upto = lambda array: F.size(F.filter(array, lambda c: c <= place))
    at = fresh("g")
    df = df.withColumn(at, upto(F.array(*[literal(g[0]) for g in groups])))
    within = upto(F.get(F.array(*[F.array(*map(literal, g)) for g in groups]), F.col(at) - 1))
    return df.withColumn(bucket, F.when(F.col(at) == 0, 0).otherwise((F.col(at) - 1) * width + within)).drop(at)


def run_ids(frame: Frame, keys: list[str]) -> tuple[Frame, str]:
    """Numbers the runs of adjacent rows with equal keys. Rows are compared within buckets of the order in parallel; the
    few rows at the ends of buckets are compared in a table of buckets."""
    f = frame.flat()
    text = F.concat_ws("\u0001", *[V.text_key(f.env[k]) for k in keys]) if keys else F.lit("")
    key, b = fresh("k"), fresh("b")
    order = list(f.order)
    df = _bucketed(f.df.withColumn(key, text), order, b)
    within = Window.partitionBy(b).orderBy(*order) if order else Window.partitionBy(b).orderBy(F.lit(0))
    prev, new, local = fresh("p"), fresh("n"), fresh("l")
    df = df.withColumn(prev, F.lag(key).over(within)).withColumn(new, F.when(F.col(prev).isNull() | (F.col(prev) != F.col(key)), 1).otherwise(0))
    df = df.withColumn(local, F.sum(new).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    ends = df.groupBy(b).agg(F.min(F.struct(*order, key)).alias("first"), F.max(F.struct(*order, key)).alias("last"), F.max(local).alias("runs"))
    chain = Window.orderBy(b)  # a row a bucket: at most RANGES
    joins = F.lag("last").over(chain).getField(key) == F.col("first").getField(key)
    # a bucket whose first run continues the last of the bucket before has one new run less
    ends = ends.withColumn("less", F.coalesce(joins.cast("int"), F.lit(0))).withColumn("upto", F.sum(F.col("runs") - F.col("less")).over(chain.rowsBetween(Window.unboundedPreceding, 0)))
    base = ends.select(F.col(b).alias(b + "e"), (F.col("upto") - F.col("runs")).alias("base"))
    run = fresh("r")
    out = df.join(F.broadcast(base), F.col(b) == F.col(b + "e")).withColumn(run, F.col("base") + F.col(local))
    return replace(f, df=out), run


def collected(frame: Frame, keys: list[str], parts: dict[str, Val], by_run: bool = True) -> Frame:
    """One row for each run of equal keys, with each part as the list of its values in order."""
    named = replace(frame, env={**{k: frame.env[k] for k in keys}, **parts})
    if by_run:
        f, run = run_ids(named, keys)
        group = [run]
    else:
        f = named.flat()
        group = [fresh("g")]
        f = replace(f, df=f.df.withColumn(group[0], F.concat_ws("\u0001", *[V.text_key(f.env[k]) for k in keys]) if keys else F.lit("")))
    order = list(f.order)
    position = F.struct(*order) if order else F.lit(0)
    aggs = [F.min(position).alias("__first")]
    first = {k: fresh("v") for k in keys}
    aggs += [F.min_by(f.env[k].col, position).alias(n) for k, n in first.items()]
    lists = {p: fresh("l") for p in parts}
    for p, n in lists.items():
        aggs.append(F.sort_array(F.collect_list(F.struct(position.alias("o"), F.to_json(f.env[p].col).alias("x") if f.env[p].dynamic else f.env[p].col.alias("x")))).alias(n) if _sortable(f.env[p].type) else F.collect_list(F.struct(position.alias("o"), f.env[p].col.alias("x"))).alias(n))
    g = f.df.groupBy(*group).agg(*aggs)
    env: dict[str, Val] = {k: Val(F.col(n), f.env[k].type) for k, n in first.items()}
    new_order = []
    for i, o in enumerate(order):
        g = g.withColumn(c := fresh("o"), F.col("__first").getField(order[i]))
        new_order.append(c)
    for p, n in lists.items():
        v = f.env[p]
        items = F.col(n) if _sortable(v.type) else F.array_sort(F.col(n), lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0))
        if v.dynamic:
            env[p] = Val(F.to_variant_object(F.transform(items, lambda x: F.parse_json(x["x"]))), VARIANT)
        elif isinstance(v.type, T.NullType):
            env[p] = Val(F.transform(items, lambda x: F.lit(None).cast("string")), T.ArrayType(T.StringType()))
        else:
            env[p] = Val(F.transform(items, lambda x: x["x"]), T.ArrayType(v.type))
    return Frame(g, env, tuple(new_order))


def _sortable(t: T.DataType) -> bool:
    return isinstance(t, T.VariantType) or not any(x in t.simpleString() for x in ("map<", "variant", "void"))
