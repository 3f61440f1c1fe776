"""Values of the query language as columns.

A value is a column with its static type. Columnar data keep their Spark types (the typed lane: whether a key is present
is known from the schema). Ragged JSON is VARIANT (the variant lane: a missing key is SQL NULL, a null is the variant
null). Functions here build expressions of built-in functions only; Python is used for what Spark can't express.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VARIANT = T.VariantType()
NULL = T.NullType()
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


class QueryError(ValueError):
    """A script that can't be evaluated."""


@dataclass(frozen=True)
class Val:
    col: Column
    type: T.DataType

    @property
    def dynamic(self) -> bool:
        return isinstance(self.type, T.VariantType)


def constant(value: object) -> Val:
    if value is None:
        return Val(F.lit(None), NULL)
    if isinstance(value, bool):
        return Val(F.lit(value), T.BooleanType())
    if isinstance(value, int):
        return Val(F.lit(value), T.LongType()) if abs(value) >= 2**31 else Val(F.lit(value), T.IntegerType())
    if isinstance(value, float):
        return Val(F.lit(value), T.DoubleType())
    if isinstance(value, str):
        return Val(F.lit(value), T.StringType())
    if value == []:
        return Val(F.array(), T.ArrayType(NULL))
    return Val(F.parse_json(F.lit(json.dumps(value))), VARIANT)


def variant_null() -> Column:
    return F.parse_json(F.lit("null"))


def to_variant(v: Val) -> Column:
    if v.dynamic:
        return v.col
    if isinstance(v.type, T.NullType):
        return variant_null()
    if isinstance(v.type, T.ArrayType) and isinstance(v.type.elementType, T.NullType):
        return F.parse_json(F.lit("[]"))
    if isinstance(v.type, T.StructType | T.ArrayType | T.MapType):
        return F.coalesce(F.to_variant_object(_plain(v).col), variant_null())
    return F.coalesce(v.col.cast("variant"), variant_null())


def _plain(v: Val) -> Val:
    """Nested void types become strings, as a variant can't be made of them."""
    if "void" in v.type.simpleString():
        return Val(v.col.cast(_no_void(v.type)), _no_void(v.type))
    return v


def _no_void(t: T.DataType) -> T.DataType:
    if isinstance(t, T.NullType):
        return T.StringType()
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_no_void(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, _no_void(t.valueType))
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _no_void(f.dataType)) for f in t.fields])
    return t


def same_type(a: T.DataType, b: T.DataType) -> bool:
    return a.simpleString() == b.simpleString()


def common_type(types: list[T.DataType]) -> T.DataType:
    """The type that holds all, VARIANT if there is no closer one."""
    some = [t for t in types if not isinstance(t, T.NullType)]
    if not some:
        return NULL
    if all(same_type(t, some[0]) for t in some):
        return some[0]
    if all(isinstance(t, NUMERIC) for t in some):
        return T.DoubleType() if any(isinstance(t, T.FloatType | T.DoubleType | T.DecimalType) for t in some) else T.LongType()
    if all(isinstance(t, T.ArrayType) for t in some):
        inner = common_type([t.elementType for t in some])
        return VARIANT if isinstance(inner, T.VariantType) else T.ArrayType(inner)
    if all(isinstance(t, T.StructType) for t in some) and len({tuple(f.name for f in t.fields) for t in some}) == 1:
        inner = [common_type([t.fields[i].dataType for t in some]) for i in range(len(some[0].fields))]
        if not any(isinstance(x, T.VariantType) for x in inner):
            return T.StructType([T.StructField(f.name, x) for f, x in zip(some[0].fields, inner)])
    return VARIANT


def coerce(v: Val, t: T.DataType) -> Column:
    if isinstance(t, T.VariantType):
        return to_variant(v)
    if isinstance(v.type, T.NullType):
        return F.lit(None).cast(t) if not isinstance(t, T.NullType) else v.col
    return v.col if same_type(v.type, t) else v.col.cast(t)


def unify(*vals: Val) -> tuple[list[Column], T.DataType]:
    t = common_type([v.type for v in vals])
    return [coerce(v, t) for v in vals], t


# -- kinds of dynamic values


def kind(col: Column) -> Column:
    return F.schema_of_variant(col)


def is_object(col: Column) -> Column:
    return kind(col).startswith("OBJECT")


def is_array(col: Column) -> Column:
    return kind(col).startswith("ARRAY")


def as_map(v: Val) -> Column:
    """map<string,variant> of a dynamic object, null for anything else."""
    return F.try_variant_get(v.col, "$", "map<string,variant>")


def as_array(v: Val) -> Column:
    """array<variant> of a dynamic array, null for anything else."""
    return F.when(is_array(v.col), v.col).cast("array<variant>")


def entry(v: Val, key: Column) -> Column:
    """The value of a key of a dynamic object, null where there is none. A key that a path can hold is looked up; a map
    of all the object's keys is made only for others."""
    plain = key.rlike("^[A-Za-z0-9_-]+\\z")
    path = F.concat(F.lit("$['"), key, F.lit("']"))
    return F.when(plain, F.try_variant_get(v.col, path, "variant")).otherwise(F.try_element_at(as_map(v), key))


def as_string(v: Val, strict: bool, what: str) -> Column:
    """The string of a value; another kind of value is an error, or null if errors are."""
    if isinstance(v.type, T.StringType):
        return v.col
    if isinstance(v.type, T.NullType):
        return _fail(f"{what}: null is no string") if strict else F.lit(None).cast("string")
    if not v.dynamic:
        raise QueryError(f"{what}: {v.type.simpleString()} is no string")
    text = F.when(kind(v.col) == "STRING", F.variant_get(v.col, "$", "string"))
    return F.coalesce(text, _fail(f"{what}: not a string")) if strict else text


def _fail(message: str) -> Column:
    return F.raise_error(F.lit(message)).cast("string")


def text_key(v: Val) -> Column:
    """A text by which values are equal as JSON values are; null is 'null'."""
    return F.coalesce(F.to_json(to_variant(v)), F.lit("null"))


# -- comparison


def equal(a: Val, b: Val) -> Column:
    """Equality that is never unknown: null equals null only."""
    if isinstance(a.type, T.NullType) or isinstance(b.type, T.NullType):
        o = b if isinstance(a.type, T.NullType) else a
        if isinstance(o.type, T.NullType):
            return F.lit(True)
        return F.is_variant_null(o.col) if o.dynamic else o.col.isNull()
    if a.dynamic or b.dynamic:
        return text_key(a) == text_key(b)
    if same_type(a.type, b.type):
        return text_key(a) == text_key(b) if isinstance(a.type, T.MapType) or "variant" in a.type.simpleString() else a.col.eqNullSafe(b.col)
    if isinstance(a.type, NUMERIC) and isinstance(b.type, NUMERIC):
        return a.col.eqNullSafe(b.col)
    if not isinstance(t := common_type([a.type, b.type]), T.VariantType):
        return coerce(a, t).eqNullSafe(coerce(b, t))
    if isinstance(a.type, T.StructType | T.ArrayType) and type(a.type) is type(b.type):
        return text_key(a) == text_key(b)
    return a.col.isNull() & b.col.isNull()  # values of different kinds are equal only if both are null


def field(v: Val, name: str) -> Val | None:
    """A field of a typed struct, None if it hasn't one."""
    if isinstance(v.type, T.StructType) and name in v.type.names:
        return Val(v.col.getField(name), v.type[name].dataType)
    return None


def compatible(a: Val, b: Val) -> Column:
    """Objects agree if they do on the keys that both have; other values if they are equal."""
    if isinstance(a.type, T.StructType) and isinstance(b.type, T.StructType):
        shared = [n for n in a.type.names if n in b.type.names]
        out = a.col.isNull() == b.col.isNull()
        for n in shared:
            out = out & compatible(field(a, n), field(b, n))
        return out
    if (a.dynamic or isinstance(a.type, T.StructType)) and (b.dynamic or isinstance(b.type, T.StructType)):
        x, y = Val(to_variant(a), VARIANT), Val(to_variant(b), VARIANT)
        mx, my = as_map(x), as_map(y)
        agree = F.forall(F.map_keys(mx), lambda k: ~F.map_contains_key(my, k) | (F.to_json(F.element_at(mx, k)) == F.to_json(F.try_element_at(my, k))))
        return (text_key(x) == text_key(y)) | (is_object(x.col) & is_object(y.col) & F.coalesce(agree, F.lit(False)))
    return equal(a, b)


def truthy(v: Val) -> Column:
    """False for null, false, 0 and what is empty."""
    t = v.type
    if isinstance(t, T.NullType):
        return F.lit(False)
    if isinstance(t, T.BooleanType):
        return F.coalesce(v.col, F.lit(False))
    if isinstance(t, NUMERIC):
        return F.coalesce(v.col != 0, F.lit(False))
    if isinstance(t, T.StringType):
        return F.coalesce(v.col != "", F.lit(False))
    if isinstance(t, T.ArrayType | T.MapType):
        return F.coalesce(F.size(v.col) > 0, F.lit(False))
    if isinstance(t, T.StructType):
        return v.col.isNotNull() & F.lit(bool(t.fields))
    if v.dynamic:
        return F.coalesce(~F.to_json(v.col).isin("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}"), F.lit(False))
    return v.col.isNotNull()


# -- combination


def struct(parts: dict[str, Val]) -> Val:
    if not parts:
        return Val(F.parse_json(F.lit("{}")), VARIANT)
    return Val(F.struct(*[v.col.alias(k) for k, v in parts.items()]), T.StructType([T.StructField(k, v.type) for k, v in parts.items()]))


def struct_parts(v: Val) -> dict[str, Val]:
    return {f.name: Val(v.col.getField(f.name), f.dataType) for f in v.type.fields}


def map_of(v: Val) -> Column:
    """map<string,variant> of an object; of null, an empty one."""
    if v.dynamic:
        return F.coalesce(as_map(v), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>")))
    if isinstance(v.type, T.MapType):
        return F.transform_values(v.col, lambda _, x: to_variant(Val(x, v.type.valueType)))
    return F.create_map(*[c for n, x in struct_parts(v).items() for c in (F.lit(n), to_variant(x))])


def merged(old: Val, new: Val) -> Val:
    """The deep merge of two values: objects merge by key, anything else is replaced by the new value."""
    if isinstance(old.type, T.StructType) and isinstance(new.type, T.StructType):
        a, b = struct_parts(old), struct_parts(new)
        both = struct({k: (merged(a[k], b[k]) if k in a and k in b else a.get(k) or b[k]) for k in [*a, *[k for k in b if k not in a]]})
        return both
    if isinstance(new.type, T.StructType) and old.dynamic:
        parts = struct_parts(new)
        m = as_map(old)
        new_map = F.create_map(*[c for k, x in parts.items() for c in (F.lit(k), to_variant(_merged_at(m, k, x)))])
        return Val(F.when(is_object(old.col), F.to_variant_object(F.map_concat(m, new_map))).otherwise(to_variant(new)), VARIANT)
    if new.dynamic and (old.dynamic or isinstance(old.type, T.StructType)):
        o = to_variant(old)
        return Val(F.parse_json(_deep_merge(F.to_json(o), F.to_json(new.col))), VARIANT)
    return new


def _merged_at(m: Column, key: str, new: Val) -> Val:
    if not isinstance(new.type, T.StructType):
        return new
    old = Val(F.coalesce(F.try_element_at(m, F.lit(key)), variant_null()), VARIANT)
    return merged(old, new)


def deep_merge(a: object, b: object) -> object:
    if isinstance(a, dict) and isinstance(b, dict):
        return {k: deep_merge(a[k], b[k]) if k in a and k in b else b.get(k, a.get(k)) for k in sorted({*a, *b})}
    return b


@F.pandas_udf(T.StringType())
def _deep_merge(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([json.dumps(deep_merge(json.loads(x), json.loads(y)), ensure_ascii=False) if x is not None and y is not None else y for x, y in zip(a, b)], dtype=object)


@F.pandas_udf(T.StringType())
def _fold_merge(first: pd.Series, patches: pd.Series) -> pd.Series:
    out = []
    for x, ps in zip(first, patches):
        v = json.loads(x)
        for p in ps:
            v = deep_merge(v, json.loads(p))
        out.append(json.dumps(v, ensure_ascii=False))
    return pd.Series(out, dtype=object)


def fold_merge(first: Column, patches: Column) -> Column:
    """JSON texts merged in order."""
    return _fold_merge(first, patches)


@F.pandas_udf(T.StringType())
def _exact_json(text: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else json.dumps(json.loads(t)) for t in text], dtype=object)


def _simple_json(v: Val) -> tuple[Column, Column] | None:
    """The JSON text of a number, a truth value or a string, and whether it is that: a string may hold what JSON writes
    otherwise. None for other types."""
    if isinstance(v.type, T.BooleanType | T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        return F.coalesce(v.col.cast("string"), F.lit("null")), F.lit(True)
    if isinstance(v.type, T.StringType):
        return F.coalesce(F.concat(F.lit('"'), v.col, F.lit('"')), F.lit("null")), F.coalesce(v.col.rlike(r"^[ !#-\[\]-~]*\z"), F.lit(True))
    return None


def json_key(v: Val, items: list[Val] | None = None) -> Column:
    """The ASCII JSON text by which ORDER BY compares: "10" is before "9", 10 before 9, and é between Z and a. items: the
    elements, if it is an array of known ones. Only what isn't simple reaches Python."""
    some = [_simple_json(x) for x in ([v] if items is None else items)]
    if not some or any(x is None for x in some):
        return _exact_json(text_key(v))
    text, simple = some[0]
    for x, s in some[1:]:
        text, simple = F.concat(text, F.lit(", "), x), simple & s
    if items is not None:
        text = F.concat(F.lit("["), text, F.lit("]"))
    elif not isinstance(v.type, T.StringType):
        return text
    return F.when(simple, text).otherwise(_exact_json(F.when(~simple, text_key(v))))


# -- regular expressions


def java_regex(pattern: str) -> str:
    """The pattern in the other dialect: only a line feed ends a line, and classes are Unicode's."""
    return "(?dU)" + re.sub(r"\(\?P<", "(?<", pattern)


def quoted(text: str) -> str:
    return re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", text)


def apply_text(f: Callable[[str], object], returns: T.DataType):  # noqa: ANN201
    """A pandas UDF of one text column that keeps nulls."""

    @F.pandas_udf(returns)
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else f(x) for x in s], dtype=object)

    return run
