"""Patterns and strict loads on streams.

The language itself is a batch language. What of it keeps no state between rows, patterns and the strict load, also runs
on a stream: the same lowering onto the same columns, so a stream and a batch give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.values import VARIANT, Val
from tessera.operators.strict_load import CARD_LINE, LineFormat, _checked, _parts, _well_quoted
from tessera.plans.frame import Frame, lower
from tessera.plans.parser import parse_pattern


def matched(df: DataFrame, pattern: str, json_col: str | None = None) -> DataFrame:
    """The variables that a pattern binds in each row of a stream: of the row itself, or of the JSON text in a column."""
    if json_col is None:
        v = Val(F.struct(*[F.col(f"`{c}`") for c in df.columns]), df.schema)
    else:
        v = Val(F.try_parse_json(F.col(json_col)), VARIANT)
    f = lower(parse_pattern(pattern), v, Frame(df, {}, ()))
    return f.df.select(*[f.env[n].col.alias(n) for n in sorted(f.env)])


def told_apart(df: DataFrame, raw_col: str, fmt: LineFormat = CARD_LINE) -> DataFrame:
    """The rows of a stream with cells (the fields of a line that loads) and reason (why a line doesn't). On a stream
    there is no anti-join of offsets: each line is diagnosed where it stands."""
    raw, cells = F.col(raw_col), F.col("__cells")
    out = df.withColumn("__cells", F.when(_well_quoted(raw), _parts(raw)))
    reason = F.when(raw.isNull(), "columns").when(~_well_quoted(raw), "quoting").when(F.size(cells) != len(fmt.fields), "columns")
    for name, ok in _checked(cells, fmt):
        reason = reason.when(~ok, name)
    out = out.withColumn("reason", reason)
    return out.withColumn("cells", F.when(F.col("reason").isNull(), cells)).drop("__cells")
