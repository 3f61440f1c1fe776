"""The registered queries of the record operators; each takes (spark, directory of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import drift, strict_load
from tessera.operators.packed import split_packed
from tessera.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every value of a field of cards that holds two or more."""
    sites = table(spark, d, "site_ref")
    rows = split_packed(table(spark, d, "card"), "rec_id", ["skills", "home_site"], "source", {"home_site": (sites, "site_name")})
    return rows.where("n_items > 1").select("rec_id", "field", "pos", "item")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every line that fails to load, with the first reason."""
    return strict_load.rejects(table(spark, d, "raw_card"), "line_id", "raw").select("line_id", "reason")


def p2_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The lines that load, as cards."""
    fields = strict_load.CARD_LINE.fields
    rows = strict_load.strict_load(table(spark, d, "raw_card"), "line_id", "raw")
    return rows.select(F.col("offset_id").alias("line_id"), *fields)


def _changes(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(table(spark, d, "card_drop"), "feed", "file_name", "dropped_at", "payload", "card_no")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Every change of a file's fields from the feed's previous file."""
    return _changes(spark, d).select(F.col("file").alias("file_name"), "change", "old_field", "new_field")


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    """All records in one consistent table, with the fields whose cast failed."""
    df = table(spark, d, "card_drop")
    types = {"card_no": "bigint", "name": "string", "mp": "string", "rarity": "string", "artist": "string", "category": "string", "subclass": "string"}
    names = drift.field_classes(_changes(spark, d), list(types))
    rows = drift.unified(df, "payload", names, types, ["drop_id", "file_name"])
    return rows.withColumn("failed", F.array_join("failed", ","))


_QUOTED = r'"(?:[^"]|"")*"'
_FIELD = rf'(?:{_QUOTED}|[^,"]*)'

_P2 = rf"""
WITH q AS (SELECT *, raw IS NOT NULL AND regexp_full_match(raw, '{_FIELD}(,{_FIELD})*', 's') AS ok FROM raw_card),
c AS (SELECT *, CASE WHEN ok THEN regexp_extract_all(',' || raw, ',({_FIELD})', 1, 's') END AS cells FROM q),
u AS (SELECT *, list_transform(cells, lambda x: CASE WHEN x[1] = '"' THEN replace(x[2:-2], '""', '"') ELSE x END) AS v FROM c),
r AS (SELECT *, CASE WHEN raw IS NULL THEN 'columns' WHEN NOT ok THEN 'quoting' WHEN len(v) <> 9 THEN 'columns'
  WHEN NOT regexp_full_match(v[6], '([1-9]\*?|-[1-9]|[0-9]?\([1-9]\))?') THEN 'mp'
  WHEN NOT regexp_full_match(v[7], '([1-9]|10|-1)?') THEN 'mind'
  WHEN regexp_matches(v[9], '[\x00-\x08\x0B-\x1F\x7F-\x{{9F}}\x{{FFFD}}]') THEN 'text' END AS reason FROM u)
"""

_P6 = """
WITH RECURSIVE f AS (SELECT feed, file_name, min(dropped_at) AS first_at FROM card_drop GROUP BY ALL),
s AS (SELECT feed, file_name, row_number() OVER (PARTITION BY feed ORDER BY first_at, file_name) AS seq FROM f),
r AS (SELECT s.feed, s.file_name, s.seq, json_extract_string(payload, '$.card_no') AS card, payload FROM card_drop c JOIN s USING (feed, file_name)),
k AS (SELECT feed, file_name, seq, card, unnest(json_keys(payload)) AS path, payload FROM r),
v AS (SELECT feed, file_name, seq, card, path, CAST(json_extract(payload, '$."' || path || '"') AS VARCHAR) AS val,
  json_type(payload, '$."' || path || '"') AS t FROM k),
w AS (SELECT *, CASE WHEN t = 'NULL' THEN NULL WHEN t IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'number' ELSE t END AS kind FROM v),
p AS (SELECT feed, file_name, seq, path, list_sort(list(DISTINCT kind) FILTER (kind IS NOT NULL)) AS kinds FROM w GROUP BY ALL),
n AS (SELECT a.feed, a.seq, a.path, a.kinds FROM p a WHERE a.seq > 1),
o AS (SELECT p.feed, p.seq + 1 AS seq, p.path, p.kinds FROM p JOIN s ON s.feed = p.feed AND s.seq = p.seq + 1),
d AS (SELECT coalesce(n.feed, o.feed) AS feed, coalesce(n.seq, o.seq) AS seq, coalesce(n.path, o.path) AS path,
  CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed'
  WHEN len(n.kinds) > 0 AND len(o.kinds) > 0 AND n.kinds <> o.kinds THEN 'retyped' END AS change
  FROM n FULL JOIN o ON n.feed = o.feed AND n.seq = o.seq AND n.path = o.path),
g AS (SELECT DISTINCT w.feed, w.seq + 1 AS seq, w.path, w.card, w.val FROM w JOIN d ON d.feed = w.feed AND d.seq = w.seq + 1 AND d.path = w.path AND d.change = 'removed' WHERE w.kind IS NOT NULL),
a AS (SELECT DISTINCT w.feed, w.seq, w.path, w.card, w.val FROM w JOIN d ON d.feed = w.feed AND d.seq = w.seq AND d.path = w.path AND d.change = 'added' WHERE w.kind IS NOT NULL),
h AS (SELECT DISTINCT feed, seq, card FROM r),
b AS (SELECT x.feed, x.seq, x.card FROM h x JOIN h y ON x.feed = y.feed AND x.seq = y.seq + 1 AND x.card = y.card),
ng AS (SELECT feed, seq, path, count(DISTINCT card) AS n FROM g JOIN b USING (feed, seq, card) GROUP BY ALL),
na AS (SELECT feed, seq, path, count(DISTINCT card) AS n FROM a JOIN b USING (feed, seq, card) GROUP BY ALL),
m AS (SELECT g.feed, g.seq, g.path AS old, a.path AS new, count(DISTINCT g.card) AS n FROM g JOIN a ON g.feed = a.feed AND g.seq = a.seq AND g.card = a.card AND g.val = a.val GROUP BY ALL),
z AS (SELECT m.*, m.n / least(ng.n, na.n) AS share FROM m JOIN ng ON ng.feed = m.feed AND ng.seq = m.seq AND ng.path = m.old JOIN na ON na.feed = m.feed AND na.seq = m.seq AND na.path = m.new),
y AS (SELECT *, row_number() OVER (PARTITION BY feed, seq, old ORDER BY share DESC, n DESC, new) AS ro,
  row_number() OVER (PARTITION BY feed, seq, new ORDER BY share DESC, n DESC, old) AS rn FROM z WHERE share >= 0.35),
x AS (SELECT feed, seq, old, new FROM y WHERE ro = 1 AND rn = 1)
"""

#: The names of each field follow from the renamings; a record's first value by name counts.
_P6_RECORDS = _P6.rstrip() + """,
wanted AS (SELECT unnest(['card_no', 'name', 'mp', 'rarity', 'artist', 'category', 'subclass']) AS field, unnest([1, 2, 3, 4, 5, 6, 7]) AS nr),
edges AS (SELECT old AS a, new AS b FROM x UNION SELECT new, old FROM x),
names AS (SELECT field, nr, field AS name FROM wanted UNION SELECT n.field, n.nr, e.b FROM names n JOIN edges e ON e.a = n.name WHERE e.b NOT IN (SELECT field FROM wanted)),
held AS (SELECT c.drop_id, n.field, n.nr, n.name, json_extract(c.payload, '$."' || n.name || '"') AS raw FROM card_drop c, names n),
given AS (SELECT * FROM held WHERE raw IS NOT NULL AND json_type(raw) <> 'NULL'),
firsts AS (SELECT drop_id, field, nr, arg_min(raw, name) AS raw, count(DISTINCT CAST(raw AS VARCHAR)) AS n FROM given GROUP BY ALL),
plain AS (SELECT *, CASE json_type(raw) WHEN 'OBJECT' THEN json_extract_string(raw, '$.value') WHEN 'ARRAY' THEN CASE WHEN json_array_length(raw) = 1 THEN json_extract_string(raw, '$[0]') END
  ELSE json_extract_string(raw, '$') END AS v FROM firsts),
checked AS (SELECT *, (CASE WHEN field = 'card_no' THEN CAST(TRY_CAST(v AS BIGINT) AS VARCHAR) ELSE v END) AS val FROM plain)
SELECT c.drop_id, c.file_name, TRY_CAST(max(val) FILTER (field = 'card_no') AS BIGINT) AS card_no, max(val) FILTER (field = 'name') AS name, max(val) FILTER (field = 'mp') AS mp,
  max(val) FILTER (field = 'rarity') AS rarity, max(val) FILTER (field = 'artist') AS artist, max(val) FILTER (field = 'category') AS category, max(val) FILTER (field = 'subclass') AS subclass,
  coalesce(string_agg(field, ',' ORDER BY nr) FILTER (raw IS NOT NULL AND (val IS NULL OR n > 1)), '') AS failed
FROM card_drop c LEFT JOIN checked k ON k.drop_id = c.drop_id GROUP BY c.drop_id, c.file_name
"""

ORACLES = {
    "p2_found": _P2 + "SELECT line_id, reason FROM r WHERE reason IS NOT NULL",
    "p2_loaded": _P2
    + "SELECT line_id, "
    + ", ".join(f"v[{i}] AS {n}" for i, n in enumerate(strict_load.CARD_LINE.fields, 1))
    + " FROM r WHERE reason IS NULL",
    "p6_found": _P6 + """
SELECT s.file_name, q.change, q.old_field, q.new_field FROM (
  SELECT d.feed, d.seq, d.change, CASE WHEN d.change = 'added' THEN '' ELSE d.path END AS old_field, CASE WHEN d.change = 'removed' THEN '' ELSE d.path END AS new_field
  FROM d WHERE d.change IS NOT NULL AND NOT EXISTS (SELECT 1 FROM x WHERE x.feed = d.feed AND x.seq = d.seq AND ((d.change = 'removed' AND x.old = d.path) OR (d.change = 'added' AND x.new = d.path)))
  UNION ALL SELECT feed, seq, 'renamed', old, new FROM x) q JOIN s USING (feed, seq)
""",
    "p6_records": _P6_RECORDS,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p2_found, p2_loaded, p6_found, p6_records)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
