"""A small JSON-schema validator: the keywords $ref, definitions, anyOf, allOf, oneOf, not, type, enum, const,
properties, required, propertyNames, additionalProperties, items, minItems, maxItems, minLength, maxLength, pattern,
minimum, maximum. Unknown keywords are ignored, as the standard says."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": lambda v: isinstance(v, str),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
    "boolean": lambda v: isinstance(v, bool),
    "number": lambda v: isinstance(v, int | float) and not isinstance(v, bool),
    "integer": lambda v: not isinstance(v, bool) and (isinstance(v, int) or (isinstance(v, float) and v.is_integer())),
}


def _same(a: object, b: object) -> bool:
    return a == b and isinstance(a, bool) == isinstance(b, bool)


def valid(value: object, schema: object, root: object = None) -> bool:
    root = schema if root is None else root
    if isinstance(schema, bool):
        return schema
    if "$ref" in schema:
        at: object = root
        for part in schema["$ref"].lstrip("#/").split("/"):
            if part:
                at = at[part.replace("~1", "/").replace("~0", "~")]
        return valid(value, at, root)
    for word, rule in schema.items():
        check = _RULES.get(word)
        if check and not check(value, rule, schema, root):
            return False
    return True


_RULES = {
    "type": lambda v, r, s, root: any(_TYPES[t](v) for t in ([r] if isinstance(r, str) else r)),
    "enum": lambda v, r, s, root: any(_same(v, x) for x in r),
    "const": lambda v, r, s, root: _same(v, r),
    "anyOf": lambda v, r, s, root: any(valid(v, x, root) for x in r),
    "allOf": lambda v, r, s, root: all(valid(v, x, root) for x in r),
    "oneOf": lambda v, r, s, root: sum(valid(v, x, root) for x in r) == 1,
    "not": lambda v, r, s, root: not valid(v, r, root),
    "required": lambda v, r, s, root: not isinstance(v, dict) or all(k in v for k in r),
    "properties": lambda v, r, s, root: not isinstance(v, dict) or all(valid(v[k], x, root) for k, x in r.items() if k in v),
    "propertyNames": lambda v, r, s, root: not isinstance(v, dict) or all(valid(k, r, root) for k in v),
    "additionalProperties": lambda v, r, s, root: not isinstance(v, dict) or all(valid(x, r, root) for k, x in v.items() if k not in s.get("properties", {})),
    "items": lambda v, r, s, root: not isinstance(v, list) or all(valid(x, r, root) for x in v),
    "minItems": lambda v, r, s, root: not isinstance(v, list) or len(v) >= r,
    "maxItems": lambda v, r, s, root: not isinstance(v, list) or len(v) <= r,
    "minLength": lambda v, r, s, root: not isinstance(v, str) or len(v) >= r,
    "maxLength": lambda v, r, s, root: not isinstance(v, str) or len(v) <= r,
    "pattern": lambda v, r, s, root: not isinstance(v, str) or re.search(r, v) is not None,
    "minimum": lambda v, r, s, root: not _TYPES["number"](v) or v >= r,
    "maximum": lambda v, r, s, root: not _TYPES["number"](v) or v <= r,
}


@lru_cache(maxsize=64)
def _schema(text: str) -> object:
    return json.loads(text)


@F.pandas_udf(T.BooleanType())
def conforms(value: pd.Series, schema: pd.Series) -> pd.Series:
    """Whether JSON texts conform to the schema texts beside them."""
    return pd.Series([valid(json.loads(v), _schema(s)) for v, s in zip(value, schema)])
