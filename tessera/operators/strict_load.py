"""Rows that fail to parse: strict load plus anti-join.

The lines keep their offsets (a line's id and a hash of the line). A strict load takes the conforming lines only and
gives typed rows; their offsets are subtracted from the raw offsets by an anti-join; what remains is diagnosed. All of
it is built-in, JVM-side expressions. Both sides of the anti-join carry offsets only, no text, so what is shuffled is a
few bytes a line; lines are unique in their offset, so no key is hot. The rejected offsets, if they are few, are sent
back to the lines; many are joined.

The regular expressions are possessive: they run in linear time and constant stack on very long lines.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A quoted stretch (quotes inside written twice).
QUOTED = r'"(?:[^"]++|"")*+"'
FIELD = rf"(?:{QUOTED}|[^,\"]*+)"


#: Up to this many rejected offsets are broadcast.
BROADCAST_REJECTS = 1_000_000


@dataclass(frozen=True)
class LineFormat:
    """Field names in order, and the checks of fields in the order in which they are reported: name -> regular
    expression that the whole value must match."""

    fields: tuple[str, ...]
    checks: tuple[tuple[str, str], ...] = field(default=())


CARD_LINE = LineFormat(
    ("print_no", "set_name", "name", "card_type", "alignment", "mp", "mind", "race", "text"),
    (
        ("mp", r"\A(?:[1-9]\*?|-[1-9]|[0-9]?\([1-9]\))?\z"),
        ("mind", r"\A(?:[1-9]|10|-1)?\z"),
        ("text", r"\A[^\x00-\x08\x0B-\x1F\x7F-\x9F�]*+\z"),
    ),
)


def _well_quoted(raw: Column) -> Column:
    return raw.rlike(rf"\A{FIELD}(?:,{FIELD})*+\z")


def _parts(raw: Column) -> Column:
    """The fields of a well-quoted line, without quoting."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), raw), F.lit(rf",({FIELD})"), 1)
    return F.transform(cells, lambda c: F.when(c.startswith('"'), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def _checked(parts: Column, fmt: LineFormat) -> list[tuple[str, Column]]:
    return [(name, F.coalesce(F.get(parts, F.lit(fmt.fields.index(name))).rlike(rule), F.lit(False))) for name, rule in fmt.checks]


def _offset(df: DataFrame, id_col: str, raw_col: str) -> list[Column]:
    return [F.col(id_col).alias("offset_id"), F.xxhash64(F.col(raw_col)).alias("offset_hash")]


def strict_load(df: DataFrame, id_col: str, raw_col: str, fmt: LineFormat = CARD_LINE) -> DataFrame:
    """The conforming lines, typed: offset_id, offset_hash and one string column per field of the format."""
    raw = F.col("raw")
    lines = df.select(*_offset(df, id_col, raw_col), F.col(raw_col).cast("string").alias("raw")).where(_well_quoted(raw))
    cells = lines.select("offset_id", "offset_hash", _parts(raw).alias("cells")).where(F.size("cells") == len(fmt.fields))
    for _, ok in _checked(F.col("cells"), fmt):
        cells = cells.where(ok)
    return cells.select("offset_id", "offset_hash", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(fmt.fields)])


def rejects(df: DataFrame, id_col: str, raw_col: str, fmt: LineFormat = CARD_LINE) -> DataFrame:
    """(id_col, raw_col, reason) of every line that the strict load doesn't take.

    reason is the first that applies of 'quoting', 'columns' and the checked fields in their order. A null line has no
    fields: 'columns'. An empty line has one. Repeated lines are each reported. Extra columns are ignored. An empty
    table gives an empty result.
    """
    loaded = strict_load(df, id_col, raw_col, fmt).select("offset_id", "offset_hash")
    offsets = df.select(*_offset(df, id_col, raw_col))
    same = offsets["offset_id"].eqNullSafe(loaded["offset_id"]) & (offsets["offset_hash"] == loaded["offset_hash"])
    left = offsets.join(loaded, same, "left_anti").select(F.col("offset_id").alias("id"), F.col("offset_hash").alias("hash")).distinct().persist()
    few = left.limit(BROADCAST_REJECTS + 1).count() <= BROADCAST_REJECTS
    lines = df.select(*_offset(df, id_col, raw_col), F.col(raw_col).cast("string").alias("raw"))
    rest = lines.join(F.broadcast(left) if few else left, F.col("offset_id").eqNullSafe(F.col("id")) & (F.col("offset_hash") == F.col("hash")), "left_semi")
    raw, cells = F.col("raw"), F.col("cells")
    reason = F.when(raw.isNull(), "columns").when(~_well_quoted(raw), "quoting").when(F.size(cells) != len(fmt.fields), "columns")
    for name, ok in _checked(cells, fmt):
        reason = reason.when(~ok, name)
    told = rest.withColumn("cells", F.when(_well_quoted(raw), _parts(raw))).withColumn("reason", reason)
    return told.select(F.col("offset_id").alias(id_col), raw.alias(raw_col), "reason")
