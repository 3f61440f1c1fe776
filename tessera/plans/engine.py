"""Clauses of the query language on frames, and the record store.

Effects are sequenced on the driver; everything else is lazy. A record store is a list of immutable segments; a write
gives new versions of the segments it changes, so a statement reads what was there before it (snapshot isolation).
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import values as V
from tessera.functions.values import VARIANT, QueryError, Val
from tessera.plans import ast as A
from tessera.plans.exprs import Expressions
from tessera.plans.frame import Frame, collected, fresh, join_condition, lower, natural_join, template_regex
from tessera.sources import io

#: Writes to a segment after which its lineage is cut.
CUT_AFTER = 8
#: The same for VARIANT records, whose merges are large expressions that would be compiled into one another.
CUT_VARIANT = 1


@dataclass(frozen=True)
class Segment:
    """Records in a column "rec", identified and ordered by the columns in order."""

    df: DataFrame
    type: T.DataType
    order: tuple[str, ...]
    writes: int = 0


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows, read from a checkpoint in the folder that the cluster names; a folder of our own only where none
    is set and all tasks run on this machine, as in tests."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise QueryError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tessera-"))
    return df.checkpoint()


class Engine:
    def __init__(self, spark: SparkSession, base: str | None = None, strict: bool = True, single_files: bool = True):
        self.spark, self.base, self.strict, self.single_files = spark, base, strict, single_files
        self.segments: list[Segment] = []
        self.globals: dict[str, Val] = {}
        self.indexes: dict[str, A.Node] = {}
        spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")  # later keys win in objects

    # -- statements

    def run(self, script: A.Script) -> DataFrame | None:
        result = None
        for i, s in enumerate(script.statements):
            self._ordered = _needs_order(s)
            result = self.statement(s, last=i == len(script.statements) - 1)
        return result

    def statement(self, s: A.Node, last: bool = True) -> DataFrame | None:
        match s:
            case A.CreateIndex(name, pattern):
                if name in self.indexes:
                    raise QueryError(f"index {name} exists")
                self.indexes[name] = pattern
                return None
            case A.DropIndex(name):
                if name not in self.indexes:
                    raise QueryError(f"no index {name}")
                del self.indexes[name]
                return None
            case A.Union(_, _):
                frames = [f for f in self.union(s) if f is not None]
                return self.union_all(frames) if frames else None
        f = self.query(s)
        return self.result(f) if f is not None else None

    def union(self, s: A.Node) -> list[Frame | None]:
        if isinstance(s, A.Union):
            return [*self.union(s.left), *self.union(s.right)]
        return [self.query(s)]

    def start(self) -> Frame:
        return Frame(self.spark.range(1).select(F.lit(True).alias(fresh("x"))), {}, (), unit=True)

    def query(self, q: A.Query) -> Frame | None:
        f = self.start()
        for clause in q.reads:
            f = self.read(clause, f)
        if isinstance(q.write, A.Save):
            return self.save(q.write.format, q.write.value, q.write.path, f, q.reads[-1].key if q.reads and isinstance(q.reads[-1], A.OrderBy) else None)
        return self.write(q.write, f, bool(q.reads)) if q.write else f

    def result(self, f: Frame) -> DataFrame:
        """The variables as columns (of a context by name, of RETURN as written), a single value as column value."""
        names = list(f.env) if "$returned" in f.env else sorted(f.env)
        cols = [_output(f.env[n]).alias("value" if n == "$value" else n) for n in names if n != "$returned"]
        ordered = self._sorted and f.order
        df = f.df.sort(*f.order) if ordered else f.df
        return df.select(*cols)

    _sorted = False
    _ordered = True

    def union_all(self, frames: list[Frame]) -> DataFrame:
        names: dict[str, list[Val | None]] = {}
        for f in frames:
            for n in f.env:
                names.setdefault(n, [])
        out = None
        types = {n: V.common_type([f.env[n].type for f in frames if n in f.env]) for n in names if n != "$returned"}
        for f in frames:
            cols = [(V.coerce(f.env[n], t) if n in f.env else F.lit(None).cast(t)) for n, t in types.items()]
            part = f.df.select(*[_output(Val(c, t)).alias("value" if n == "$value" else n) for c, (n, t) in zip(cols, types.items())])
            out = part if out is None else out.unionByName(part)
        return out

    # -- expressions

    def compiler(self, f: Frame) -> Expressions:
        return Expressions(f.env, self.globals, self.strict)

    def lift(self, f: Frame, *exprs: A.Node) -> tuple[Frame, list[A.Node]]:
        """The frame with a variable for each subquery of the expressions, and the expressions that read them."""

        def walk(e: A.Node) -> A.Node:
            nonlocal f
            if isinstance(e, A.Exists | A.ArrayOf):
                name = "$" + fresh("q")
                v = self._local(e, f)
                if v is None:
                    f, v = self._joined(e, f)
                f = replace(f, env={**f.env, name: v})
                return A.Var(name)
            return A.rebuild(e, walk)

        lifted = [walk(e) for e in exprs]
        return f, lifted

    def value(self, f: Frame, e: A.Node) -> tuple[Frame, Val]:
        f, (e,) = self.lift(f, e)
        return f, self.compiler(f).value(e)

    def _local(self, e: A.Exists | A.ArrayOf, f: Frame) -> Val | None:
        """A subquery over one array of the row itself: a higher-order function, no join."""
        q = e.query
        first, *rest = q.reads
        if not isinstance(first, A.With) or not all(isinstance(c, A.Where) for c in rest):
            return None
        unwound = [(x, p) for x, p in first.pairs if isinstance(p, A.PUnwind)]
        plain = [(x, p) for x, p in first.pairs if not isinstance(p, A.PUnwind)]
        if len(unwound) != 1 or not isinstance(unwound[0][1].pattern, A.PVar) or len(unwound[0][1].pattern.path) != 1:
            return None
        if not all(isinstance(x, A.Var) and (p is None or isinstance(p, A.PVar)) for x, p in plain):
            return None
        conditions = [c.condition for c in rest]
        if any(A.has(c, (A.Exists, A.ArrayOf, A.Aggregate)) for c in conditions) or A.has(unwound[0][0], (A.Exists, A.ArrayOf, A.Aggregate)):
            return None
        value = q.write.value if q.write is not None else None
        if value is not None and A.has(value, (A.Exists, A.ArrayOf, A.Aggregate)):
            return None
        if any(_python(c) for c in [*conditions, *([value] if value is not None else [])]):
            return None  # Python functions can't stand in a lambda
        if isinstance(e, A.ArrayOf) and value is None:
            return None
        source = self.compiler(f).value(unwound[0][0])
        if isinstance(source.type, T.ArrayType):
            array, t = source.col, source.type.elementType
        elif source.dynamic:
            array, t = V.as_array(source), VARIANT
        else:
            return Val(F.lit(False), T.BooleanType()) if isinstance(e, A.Exists) else V.constant([])
        name = unwound[0][1].pattern.path[0]
        outer = {(p.path[0] if p is not None else x.name): self.compiler(f).value(x) for x, p in plain}

        def inner(x: Column) -> Expressions:
            return Expressions({**outer, name: Val(x, t)}, self.globals, self.strict)

        def keep(x: Column) -> Column:
            test = F.lit(True)
            for c in conditions:
                test = test & inner(x).test(c)
            return test

        if isinstance(e, A.Exists):
            return Val(F.coalesce(F.exists(array, keep) if conditions else F.size(array) > 0, F.lit(False)), T.BooleanType())
        kept = F.filter(array, keep) if conditions else array
        kinds: list[T.DataType] = []

        def build(x: Column) -> Column:
            v = inner(x).value(value)
            kinds.append(v.type)
            return v.col

        made = F.transform(kept, build)
        t2 = kinds[-1]
        if isinstance(t2, T.VariantType):
            return Val(F.coalesce(F.to_variant_object(made), F.parse_json(F.lit("[]"))), VARIANT)
        return Val(F.coalesce(made, F.array().cast(T.ArrayType(t2))), T.ArrayType(t2))

    def _joined(self, e: A.Exists | A.ArrayOf, f: Frame) -> tuple[Frame, Val]:
        """A subquery in general: it runs over all rows at once, and its results are joined back by the row."""
        if isinstance(e, A.ArrayOf) and (got := self._keyed(e, f)) is not None:
            return got
        outer, ids = self._identified(f)
        # the row's identity goes along as variables that no clause drops
        sub = replace(outer, env={**outer.env, **{f"$id{i}": Val(F.col(c), outer.df.schema[c].dataType) for i, c in enumerate(ids)}})
        for clause in e.query.reads:
            sub = self.read(clause, sub, within=True)
        row = [sub.env[f"$id{i}"].col for i in range(len(ids))]
        if isinstance(e, A.Exists):
            hit = sub.df.select(*[c.alias(i + "h") for c, i in zip(row, ids)]).distinct()
            flag = fresh("x")
            df = outer.df.join(hit.withColumn(flag, F.lit(True)), _same_row(ids), "left").drop(*[i + "h" for i in ids])
            return replace(outer, df=df), Val(F.coalesce(F.col(flag), F.lit(False)), T.BooleanType())
        if e.query.write is not None:
            sub, v = self.value(sub, e.query.write.value)
        else:
            v = V.struct({k: sub.env[k] for k in sorted(sub.env) if k not in outer.env and not k.startswith("$")})
        x = fresh("a")
        text = V.text_key(v) if v.dynamic or isinstance(v.type, T.NullType) else v.col
        # taken out of the frame under plain names: the subquery may have renamed its columns
        hs, rest = [i + "h" for i in ids], [f"__s{k}" for k in range(len(sub.order))]
        plain = sub.df.select(*[c.alias(h) for c, h in zip(row, hs)], *[F.col(o).alias(n) for o, n in zip(sub.order, rest)], text.alias("__x"))
        position = F.struct(*rest).alias("o") if rest else F.lit(0).alias("o")
        got = plain.groupBy(*hs).agg(F.collect_list(F.struct(position, F.col("__x").alias("x"))).alias(x))
        got = got.select(*hs, F.array_sort(F.col(x), lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)).alias(x))
        df = outer.df.join(got, _same_row(ids), "left").drop(*[i + "h" for i in ids])
        return replace(outer, df=df), self._listed(x, v)

    def _keyed(self, e: A.ArrayOf, f: Frame) -> tuple[Frame, Val] | None:
        """An array of one MATCH or LOAD that meets the row in plain keys only: it is collected by the keys, and the rows
        are joined with the lists. None where that isn't so."""
        first, *rest = e.query.reads
        if f.unit or not isinstance(first, A.Match | A.Load) or not all(isinstance(c, A.Where | A.OrderBy) for c in rest):
            return None
        parts = [c.condition if isinstance(c, A.Where) else c.key for c in rest] + ([e.query.write.value] if e.query.write is not None else [])
        if any(A.has(x, (A.Exists, A.ArrayOf, A.Aggregate)) for x in parts):
            return None
        inner = self.matches(first.pattern) if isinstance(first, A.Match) else self.load(first.format, first.path, first.pattern, self.start())
        keys = [n for n in inner.env if n in f.env]
        used = {n for x in parts for n in A.variables(x)}
        atomic = (T.StringType, T.IntegralType, T.BooleanType, T.DateType)
        if not keys or not used <= set(inner.env) or not all(isinstance(inner.env[n].type, atomic) and V.same_type(inner.env[n].type, f.env[n].type) for n in keys):
            return None
        for clause in rest:
            inner = self.read(clause, inner, within=True)
        if e.query.write is not None:
            inner, v = self.value(inner, e.query.write.value)
        else:
            v = V.struct({k: inner.env[k] for k in sorted(inner.env) if k not in f.env})
        outer = f.flat()
        text = V.text_key(v) if v.dynamic or isinstance(v.type, T.NullType) else v.col
        names = {n: fresh("k") for n in keys}
        position = F.struct(*[F.col(o) for o in inner.order]) if inner.order else F.lit(0)
        x = fresh("a")
        got = inner.df.select(*[inner.env[n].col.alias(k) for n, k in names.items()], position.alias("o"), text.alias("x"))
        got = got.groupBy(*names.values()).agg(F.collect_list(F.struct("o", "x")).alias(x))
        got = got.select(*names.values(), F.array_sort(F.col(x), lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)).alias(x))
        on = F.lit(True)
        for n, k in names.items():
            on = on & outer.env[n].col.eqNullSafe(F.col(k))
        df = outer.df.join(got, on, "left").drop(*names.values())
        return replace(outer, df=df), self._listed(x, v)

    def _listed(self, x: str, v: Val) -> Val:
        """The values of a column of (place, value) lists; none as the empty list."""
        if v.dynamic or isinstance(v.type, T.NullType):
            return Val(F.coalesce(F.to_variant_object(F.transform(F.col(x), lambda s: F.parse_json(s["x"]))), F.parse_json(F.lit("[]"))), VARIANT)
        return Val(F.coalesce(F.transform(F.col(x), lambda s: s["x"]), F.array().cast(T.ArrayType(v.type))), T.ArrayType(v.type))

    def _identified(self, f: Frame) -> tuple[Frame, list[str]]:
        """A frame whose order identifies its rows."""
        if f.unit:
            n = fresh("o")
            return Frame(f.df.withColumn(n, F.lit(0).cast("long")), {}, (n,)), [n]
        flat = f.flat()
        return flat, list(flat.order)

    # -- read clauses

    def read(self, clause: A.Node, f: Frame, within: bool = False) -> Frame:
        match clause:
            case A.Load(fmt, path, pattern):
                return self.load(fmt, path, pattern, f)
            case A.Match(pattern):
                return natural_join(f, self.matches(pattern, f))
            case A.With(pairs):
                return self.project(pairs, f)
            case A.Set(A.PGlobal(name), value):
                return self.set_global(name, value, f)
            case A.Set(target, value):
                return self.set_variable(target, value, f)
            case A.Where(condition):
                return self.where(condition, f)
            case A.OrderBy(key):
                f, (key,) = self.lift(f, key)
                ex = self.compiler(f)
                items = [ex.value(e) for _, e in key.parts] if isinstance(key, A.Array) and not any(spread for spread, _ in key.parts) else None
                n = fresh("o")
                out = replace(f, df=f.df.withColumn(n, V.json_key(ex.value(key), items)), order=(n, *f.order), unit=False)
                self._sorted = self._sorted or not within
                return out
        raise QueryError(f"{type(clause).__name__} is no clause to read")

    def matches(self, pattern: A.Node, outer: Frame | None = None) -> Frame:
        """The bindings of all records of the store, a frame of its own."""
        frames = []
        for i, s in enumerate(self.segments):
            df = s.df.withColumn(first := fresh("o"), F.lit(i).cast("long"))
            f = Frame(df, {}, (first, *s.order))
            frames.append(lower(pattern, Val(F.col("rec"), s.type), f))
        if not frames:
            names = dict.fromkeys(A.pattern_variables(pattern))
            empty = self.spark.range(0).select(F.col("id").alias(o := fresh("o")))
            return Frame(empty, {n: V.constant(None) for n in names}, (o,))
        return _stacked(frames)

    def load(self, fmt: str, path: A.Node, pattern: A.Node, f: Frame) -> Frame:
        docs, path_pattern = self._documents(fmt, path, f)
        right = docs
        if path_pattern is not None:
            right = lower(path_pattern, docs.env["$path"], right)
        right = lower(pattern, docs.env["$doc"], right)
        right = replace(right, env={k: v for k, v in right.env.items() if not k.startswith("$")})
        return natural_join(f, right)

    def _documents(self, fmt: str, path: A.Node, f: Frame) -> tuple[Frame, A.Node | None]:
        match path:
            case A.PConst(str(p)):
                full = io.absolute(p, self.base)
                if io._local(full) and not os.path.exists(full.removeprefix("file://")):
                    raise QueryError(f"no file {p}")
                return io.read_documents(self.spark, fmt, [full], self._ordered, with_path=False), None
            case A.PTemplate(literals, patterns):
                full = (io.absolute(literals[0], self.base), *literals[1:])
                files = io.existing(io.template_glob(full))
                return io.read_documents(self.spark, fmt, files, self._ordered), A.PTemplate(full, patterns)
        raise QueryError("a path is a string or a template")

    def project(self, pairs: tuple, f: Frame) -> Frame:
        values = [e for e, _ in pairs]
        if any(A.has(e, (A.Aggregate,)) for e in values):
            f, values = self.aggregate(values, f)
        f, values = self.lift(f, *values)
        old = f
        new = replace(f, env={k: v for k, v in f.env.items() if k.startswith("$id")}, unit=False)
        ex = self.compiler(old)
        for (_, pattern), e in zip(pairs, values):
            if isinstance(e, A.Star):
                for k, v in old.env.items():
                    if not k.startswith("$"):
                        new = new.bind(k, v)
            elif pattern is None:
                new = new.bind(e.name, ex.value(e))
            else:
                new = lower(pattern, ex.value(e), new)
        return new

    def aggregate(self, values: list[A.Node], f: Frame) -> tuple[Frame, list[A.Node]]:
        """Rows collected by runs of the variables outside of [], and the expressions over the lists."""
        f, values = self.lift(f, *values)
        parts: dict[str, A.Node] = {}

        def walk(e: A.Node) -> A.Node:
            if isinstance(e, A.Aggregate):
                name = "$" + fresh("g")
                parts[name] = e.inner
                return A.Var(name)
            return A.rebuild(e, walk)

        out = [walk(e) for e in values]
        keys = list(dict.fromkeys([*[k for k in f.env if k.startswith("$id")], *[v for e in out for v in A.variables(e) if v not in parts]]))
        ex = self.compiler(f)
        return collected(f, keys, {n: ex.value(e) for n, e in parts.items()}), out

    def set_global(self, name: str, value: A.Node, f: Frame) -> Frame:
        f, v = self.value(f, value)
        last = f.df.select(*f.order, F.to_json(V.to_variant(v)).alias("x"))
        rows = (last.sort(*[F.desc(o) for o in f.order]) if f.order else last).limit(1).collect()
        if rows:
            import json

            self.globals[name] = V.constant(json.loads(rows[0]["x"]))
        return f

    def set_variable(self, target: A.PVar, value: A.Node, f: Frame) -> Frame:
        f, v = self.value(f, value)
        name, *path = target.path
        old = f.env.get(name)
        if not path:
            mergeable = old is not None and isinstance(old.type, T.StructType | T.VariantType) and isinstance(v.type, T.StructType | T.VariantType)
            new = V.merged(old, v) if mergeable else v
        else:
            for part in reversed(path):
                v = V.struct({part: v})
            new = V.merged(old, v) if old is not None else v
        if new.dynamic:
            # a column of its own: what is built on it refers to it instead of holding its expression many times
            f, column = f.with_column(new.col)
            new = Val(F.col(column), new.type)
        return replace(f, env={**f.env, name: new}, unit=False)

    def where(self, condition: A.Node, f: Frame) -> Frame:
        for c in A.conjuncts(condition):
            negated = isinstance(c, A.Not)
            e = c.inner if negated else c
            if isinstance(e, A.Exists) and self._local(e, f) is None:
                if (g := self._semi_join(e, f, negated)) is not None:
                    f = g
                    continue
            f, (c,) = self.lift(f, c)
            f = f.where(self.compiler(f).test(c))
        return f

    def _semi_join(self, e: A.Exists, f: Frame, negated: bool) -> Frame | None:
        """[NOT] EXISTS of one MATCH or LOAD with conditions: a semi or anti join on the shared variables."""
        first, *rest = e.query.reads
        if f.unit or not isinstance(first, A.Match | A.Load) or not all(isinstance(c, A.Where) for c in rest):
            return None
        if any(A.has(c.condition, (A.Exists, A.ArrayOf, A.Aggregate)) or _python(c.condition) for c in rest):
            return None
        if isinstance(first, A.Match):
            right = self.matches(first.pattern)
        else:
            right = self.load(first.format, first.path, first.pattern, self.start())
        outer, b = f.flat(), right.flat()
        shared = [n for n in b.env if n in outer.env]
        condition = F.lit(True)
        for n in shared:
            condition = condition & join_condition(outer.env[n], b.env[n])
        both = Expressions({**b.env, **outer.env}, self.globals, self.strict)
        for c in rest:
            condition = condition & both.test(c.condition)
        return replace(outer, df=outer.df.join(b.df, condition, "left_anti" if negated else "left_semi"))

    # -- write clauses

    def write(self, clause: A.Node, f: Frame, has_reads: bool) -> Frame | None:
        match clause:
            case A.Return(value, distinct):
                return self.returned(value, distinct, f)
            case A.Create(value):
                self.create(value, f)
            case A.Merge(patch, pattern):
                self.merge(patch, pattern, f, has_reads)
            case A.Delete(pattern):
                self.delete(pattern, f, has_reads)
        return None

    def returned(self, value: A.Node, distinct: bool, f: Frame) -> Frame:
        f, (value,) = self.lift(f, value)
        v = self.compiler(f).value(value)
        env = V.struct_parts(v) if isinstance(v.type, T.StructType) and isinstance(value, A.Object) else {"$value": v}
        if isinstance(value, A.Object) and isinstance(v.type, T.StructType):
            # the parts themselves, not fields of a struct: what isn't asked for is never computed
            env = self._parts(value, f) or env
        out = replace(f, env={"$returned": V.constant(True), **env}, unit=False)
        if not distinct:
            return out
        flat = replace(out, env={k: x for k, x in env.items()}).flat()
        key = [x.col if _groupable(x.type) else V.text_key(x) for x in flat.env.values()]
        names = {k: fresh("k") for k in flat.env}
        df = flat.df.select(*flat.order, *[x.col for x in flat.env.values()], *[c.alias(n) for c, n in zip(key, names.values())])
        position = F.struct(*flat.order) if flat.order else F.lit(0)
        plain = all(_groupable(x.type) for x in flat.env.values())
        firsts = {k: fresh("v") for k in flat.env}
        # without an order to keep, a plain distinct
        aggs = [F.min(position).alias("__first")] if self._sorted else []
        if plain and not self._sorted:
            g = df.select(*names.values()).distinct()
            return Frame(g, {"$returned": V.constant(True), **{k: Val(F.col(n), flat.env[k].type) for k, n in names.items()}}, ())
        aggs += [F.min_by(F.to_json(flat.env[k].col) if flat.env[k].dynamic else flat.env[k].col, position).alias(n) for k, n in firsts.items()]
        g = df.groupBy(*names.values()).agg(*aggs)
        env = {k: Val(F.parse_json(F.col(n)) if flat.env[k].dynamic else F.col(n), flat.env[k].type) for k, n in firsts.items()}
        order = []
        if self._sorted:
            for o in flat.order:
                g = g.withColumn(c := fresh("o"), F.col("__first").getField(o))
                order.append(c)
        return Frame(g, {"$returned": V.constant(True), **env}, tuple(order))

    def _parts(self, value: A.Object, f: Frame) -> dict[str, Val] | None:
        ex, out = self.compiler(f), {}
        for key, e in value.parts:
            v = ex.value(e)
            if key is not None:
                out.pop(key, None)
                out[key] = v
            elif isinstance(v.type, T.StructType):
                for k, x in V.struct_parts(v).items():
                    out.pop(k, None)
                    out[k] = x
            else:
                return None
        return out or None

    def create(self, value: A.Node, f: Frame) -> None:
        f, v = self.value(f, value)
        v = V._plain(v)
        order = {o: fresh("r") for o in f.order}
        df = f.df.select(*[F.col(o).alias(n) for o, n in order.items()], v.col.alias("rec"))
        if not order:
            order = {"": (n := fresh("r"))}
            df = df.withColumn(n, F.lit(0).cast("long"))
        if isinstance(v.type, T.VariantType):
            df = df.withColumn("rec", _computed_once(F.col("rec")))
        self.segments.append(Segment(df, v.type, tuple(order.values())))

    def create_from(self, df: DataFrame) -> None:
        """Records of a DataFrame: a row is an object of the typed lane, ordered as Spark reads them."""
        rec = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        n = fresh("r")
        self.segments.append(Segment(df.select(F.monotonically_increasing_id().alias(n), rec.alias("rec")), df.schema, (n,)))

    def _hit(self, s: Segment, pattern: A.Node) -> Frame:
        return lower(pattern, Val(F.col("rec"), s.type), Frame(s.df, {}, s.order))

    def _condition(self, s: Segment, pattern: A.Node) -> Column | None:
        """The pattern as a condition on the record alone, if it has no fan-out."""
        if _fans_out(pattern):
            return None
        probe = _Conditions()
        lower(pattern, Val(F.col("rec"), s.type), Frame(probe, {}, ()))
        out = F.lit(True)
        for c in probe.found:
            out = out & F.coalesce(c, F.lit(False))
        return out

    def merge(self, patch: A.Node, pattern: A.Node, f: Frame, has_reads: bool) -> None:
        if A.has(patch, (A.Aggregate,)):
            # the target's variables are keys too
            keys = [A.Var(n) for n in dict.fromkeys(A.pattern_variables(pattern)) if n in f.env]
            f, (patch, *_) = self.aggregate([patch, *keys], f)
        f, p = self.value(f, patch)
        for i, s in enumerate(self.segments):
            test = self._condition(s, pattern)
            if not has_reads and test is not None:
                self._replace(i, s, test, p)
            else:
                self._merge_join(i, s, pattern, f, p)

    def _replace(self, i: int, s: Segment, test: Column, p: Val) -> None:
        rec = Val(F.col("rec"), s.type)
        new = V.merged(rec, p)
        if isinstance(new.type, T.StructType) and _same_shape(s.type, new.type):
            col, t = F.when(test, new.col.cast(_no_null(s.type, new.type))).otherwise(rec.col), s.type
        else:
            wide = Val(V.to_variant(rec), VARIANT)
            col, t = F.when(test, V.to_variant(V.merged(wide, p))).otherwise(wide.col), VARIANT
        self._store(i, s, s.df.withColumn("rec", col), t)

    def _merge_join(self, i: int, s: Segment, pattern: A.Node, f: Frame, p: Val) -> None:
        target = self._hit(s, pattern).flat() if not s.order else self._keep_order(s, pattern)
        named = replace(f, env={**{k: v for k, v in f.env.items() if k in target[0].env}, "$patch": p}).flat()
        condition = F.lit(True)
        for n in target[0].env:
            if n in named.env and n != "$patch":
                condition = condition & join_condition(target[0].env[n], named.env[n])
        ids = target[1]
        pairs = target[0].df.join(named.df, condition)
        pv = named.env["$patch"]
        position = F.struct(*named.order) if named.order else F.lit(0)
        static = isinstance(pv.type, T.StructType)
        new = fresh("p")
        if static:
            # all patches have the same keys: the last one of a record counts
            got = pairs.groupBy(*ids).agg(F.max_by(F.struct(pv.col.alias("p")), position).alias(new))
            got = got.select(*ids, F.col(new).getField("p").alias(new))
        else:
            got = pairs.groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct(position.alias("o"), V.text_key(pv).alias("x")))).alias(new))
            got = got.select(*ids, F.transform(new, lambda x: x["x"]).alias(new))
        hit = fresh("h")
        got = got.select(*[F.col(c).alias(c + "m") for c in ids], F.col(new), F.lit(True).alias(hit))
        on = F.lit(True)
        for o, c in zip(s.order, ids):
            on = on & F.col(o).eqNullSafe(F.col(c + "m"))
        df = s.df.join(got, on, "left")
        rec = Val(F.col("rec"), s.type)
        test = F.col(hit).isNotNull()
        if static:
            merged = V.merged(rec, Val(F.col(new), pv.type))
            if isinstance(merged.type, T.StructType) and _same_shape(s.type, merged.type):
                col, t = F.when(test, merged.col.cast(_no_null(s.type, merged.type))).otherwise(rec.col), s.type
            else:
                wide = Val(V.to_variant(rec), VARIANT)
                col, t = F.when(test, V.to_variant(V.merged(wide, Val(F.col(new), pv.type)))).otherwise(wide.col), VARIANT
        else:
            wide = V.to_variant(rec)
            col, t = F.when(test, F.parse_json(V.fold_merge(F.to_json(wide), F.coalesce(F.col(new), F.array().cast("array<string>"))))).otherwise(wide), VARIANT
        self._store(i, s, df.select(*s.order, col.alias("rec")), t)

    def _keep_order(self, s: Segment, pattern: A.Node) -> tuple[Frame, list[str]]:
        hit = self._hit(s, pattern)
        ids = [fresh("i") for _ in s.order]
        df = hit.df.select("*", *[F.col(o).alias(n) for o, n in zip(s.order, ids)])
        names = {v: fresh("v") for v in hit.env}
        flat = df.select(*ids, *[hit.env[v].col.alias(n) for v, n in names.items()])
        return Frame(flat, {v: Val(F.col(n), hit.env[v].type) for v, n in names.items()}, ()), ids

    def _store(self, i: int, s: Segment, df: DataFrame, t: T.DataType) -> None:
        writes = s.writes + 1
        if writes >= (CUT_VARIANT if isinstance(t, T.VariantType) else CUT_AFTER):
            df, writes = cut_lineage(df), 0
        self.segments[i] = Segment(df, t, s.order, writes)

    def delete(self, pattern: A.Node, f: Frame, has_reads: bool) -> None:
        if isinstance(pattern, A.PVar) and not has_reads:
            self.segments = []
            return
        for i, s in enumerate(self.segments):
            test = self._condition(s, pattern)
            if not has_reads and test is not None:
                self._store(i, s, s.df.where(~test), s.type)
                continue
            target, ids = self._keep_order(s, pattern)
            outer = f.flat()
            condition = F.lit(True)
            for n in target.env:
                if n in outer.env:
                    condition = condition & join_condition(target.env[n], outer.env[n])
            gone = target.df.join(outer.df, condition, "left_semi").select(*[F.col(c).alias(c + "m") for c in ids]).distinct()
            on = F.lit(True)
            for o, c in zip(s.order, ids):
                on = on & F.col(o).eqNullSafe(F.col(c + "m"))
            self._store(i, s, s.df.join(gone, on, "left_anti"), s.type)

    def save(self, fmt: str, value: A.Node, path: A.Node, f: Frame, sorted_by: A.Node | None = None) -> None:
        if fmt == "JSON" or fmt not in A_SAVED:
            raise QueryError(f"SAVE {fmt} isn't supported")
        f, (value, path) = self.lift(f, value, path)
        ex = self.compiler(f)
        v = ex.value(value)
        if fmt in ("PARQUET", "ORC", "CSV"):
            parts = V.struct_parts(V._plain(v)) if isinstance(v.type, T.StructType) else {"value": v}
            out = f.df.select(*[_output(x).alias(k) for k, x in parts.items()])
            out.write.mode("overwrite").format(fmt.lower()).options(**({"header": True} if fmt == "CSV" else {})).save(io.absolute(_constant_path(path), self.base))
            return
        line = V.text_key(v) if fmt == "JSONL" else V.as_string(v, self.strict, "SAVE TEXT")
        order = list(f.order)
        if isinstance(path, A.Const):
            if not f.df.select(F.lit(1)).isEmpty():
                io.write_lines(f.df, line, order, io.absolute(path.value, self.base), self.single_files)
            return
        where = F.concat(F.lit(io.absolute("", self.base)), V.as_string(ex.value(path), self.strict, "SAVE"))
        if _one_run(path, sorted_by):
            io.write_routed(f.df, where, line, order, io.absolute("", self.base), self.single_files)
            return
        # a path that comes back after another starts its file again: the last run of each path counts
        from tessera.plans.frame import run_ids

        keyed = replace(f, env={"$p": Val(where, T.StringType()), "$l": Val(line, T.StringType())})
        g, run = run_ids(keyed, ["$p"])
        p = g.env["$p"].col
        last = g.df.groupBy(p.alias("__p")).agg(F.max(run).alias("__run"))
        kept = g.df.join(last, p.eqNullSafe(F.col("__p")) & (F.col(run) == F.col("__run")))
        io.write_routed(kept, p, g.env["$l"].col, list(g.order), io.absolute("", self.base), self.single_files)


A_SAVED = ("JSONL", "TEXT", "PARQUET", "ORC", "CSV")


def _computed_once(rec: Column) -> Column:
    """The same value, behind which the optimizer doesn't copy the expression into every condition on the record: a chain
    of writes would double it each time. Only for VARIANT records, of which no condition reaches a scan anyway."""
    # of rand() the optimizer knows that it is never negative, and drops the condition
    return F.when(F.spark_partition_id() >= 0, rec)


def _needs_order(s: A.Node) -> bool:
    """Whether what a statement gives depends on the order or the identity of rows."""
    match s:
        case A.Union(a, b):
            return _needs_order(a) or _needs_order(b)
        case A.Query(reads, write):
            if isinstance(write, A.Create | A.Merge | A.Delete | A.Save):
                return True
            return any(map(_clause_needs_order, reads)) or (write is not None and _expression_needs_order(write.value))
    return True


def _clause_needs_order(c: A.Node) -> bool:
    match c:
        case A.OrderBy(_) | A.Set(A.PGlobal(_), _):
            return True
        case A.With(pairs):
            return any(_expression_needs_order(e) for e, _ in pairs)
        case A.Set(_, value):
            return _expression_needs_order(value)
        case A.Where(condition):
            # a [NOT] EXISTS of one MATCH or LOAD is a semi or anti join, which needs no identity
            return any(_expression_needs_order(e) for e in A.conjuncts(condition) if not _plain_exists(e))
    return False


def _plain_exists(e: A.Node) -> bool:
    if isinstance(e, A.Not):
        e = e.inner
    if not isinstance(e, A.Exists):
        return False
    first, *rest = e.query.reads
    return isinstance(first, A.Match | A.Load) and all(isinstance(c, A.Where) and not _expression_needs_order(c.condition) and not _python(c.condition) for c in rest)


def _expression_needs_order(e: A.Node) -> bool:
    return A.has(e, (A.Exists, A.ArrayOf, A.Aggregate))


def _constant_path(path: A.Node) -> str:
    if not isinstance(path, A.Const):
        raise QueryError("a directory to save to is a constant")
    return str(path.value)


class _Conditions:
    """Stands for a DataFrame and notes the conditions of a pattern without fan-out."""

    def __init__(self) -> None:
        self.found: list[Column] = []

    def where(self, condition: Column) -> _Conditions:
        self.found.append(condition)
        return self


def _fans_out(p: A.Node) -> bool:
    match p:
        case A.PUnwind(_):
            return True
        case A.PUnpack(k, v):
            return not isinstance(k, A.PConst) or _fans_out(v)
        case A.PAlias(q, _):
            return _fans_out(q)
        case A.PObject(pairs, rest):
            return any(_fans_out(x.pattern) for x in pairs) or (rest is not None and _fans_out(rest))
        case A.PTuple(elements, _):
            return any(map(_fans_out, elements))
        case A.PTemplate(_, patterns):
            return any(map(_fans_out, patterns))
    return False


def _one_run(path: A.Node, sorted_by: A.Node | None) -> bool:
    """Whether the rows of a path are adjacent whatever the values are: the path has one variable, and ORDER BY has it
    alone or first in an array, whose JSON text begins with it."""
    first = sorted_by.parts[0] if isinstance(sorted_by, A.Array) and sorted_by.parts else (False, sorted_by)
    match path, first:
        case A.Template(_, (A.Var(name),)), (False, A.Var(by)):
            return name == by
    return False


def _python(e: A.Node) -> bool:
    """Whether an expression needs a Python function."""
    if isinstance(e, A.Valid) or (isinstance(e, A.Call) and e.method == "replace" and len(e.args) > 2):
        return True
    if isinstance(e, A.Element) and isinstance(e.subject, A.Call) and e.subject.method == "match":
        return True
    return any(map(_python, A.children(e)))


def _same_row(ids: list[str]) -> Column:
    out = F.lit(True)
    for i in ids:
        out = out & F.col(i).eqNullSafe(F.col(i + "h"))
    return out


def _groupable(t: T.DataType) -> bool:
    return not any(x in t.simpleString() for x in ("map<", "variant", "void"))


def _same_shape(a: T.DataType, b: T.DataType) -> bool:
    """Whether b holds what a does but for nulls, so that a record of a can take values of b."""
    if isinstance(b, T.NullType) or V.same_type(a, b):
        return True
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return a.names == b.names and all(_same_shape(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields))
    return False


def _no_null(a: T.DataType, b: T.DataType) -> T.DataType:
    return T.StructType([T.StructField(x.name, x.dataType) for x in a.fields])


def _output(v: Val) -> Column:
    return V._plain(v).col


def _stacked(frames: list[Frame]) -> Frame:
    """Frames one after another; variables get the type that holds all of theirs."""
    if len(frames) == 1:
        return frames[0]
    names = list(dict.fromkeys(n for f in frames for n in f.env))
    types = {n: V.common_type([f.env[n].type for f in frames if n in f.env]) for n in names}
    width = max(len(f.order) for f in frames)
    vs, os_ = {n: fresh("v") for n in names}, [fresh("o") for _ in range(width)]
    kinds = [{f.df.schema[f.order[i]].dataType.simpleString() for f in frames if len(f.order) > i} for i in range(width)]

    def placed(f: Frame, i: int) -> Column:
        kind = "string" if len(kinds[i]) > 1 else next(iter(kinds[i]))
        if len(f.order) <= i:
            return F.lit(None).cast(kind)
        c = F.col(f.order[i])
        # places are compared within one frame only; numbers become texts of the same order
        return F.lpad(c.cast("string"), 20, "0") if kind == "string" and not isinstance(f.df.schema[f.order[i]].dataType, T.StringType) else c.cast(kind)

    out = None
    for f in frames:
        order = [placed(f, i) for i in range(width)]
        env = [V.coerce(f.env[n], types[n]) if n in f.env else F.lit(None).cast(types[n]) for n in names]
        part = f.df.select(*[c.alias(n) for c, n in zip(order, os_)], *[c.alias(vs[n]) for c, n in zip(env, names)])
        out = part if out is None else out.unionByName(part)
    return Frame(out, {n: Val(F.col(vs[n]), types[n]) for n in names}, tuple(os_))


__all__ = ["Engine", "Segment", "cut_lineage", "template_regex"]
