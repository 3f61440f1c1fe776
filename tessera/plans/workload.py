"""A workload in five scripts, as users of the language run it: extract records from files, transform them, load them
into files by kind, verify those, and list what is missing.

The files stand in a folder that all executors see: below the checkpoint folder of the session, or in a temporary one
where all tasks run on this machine.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.values import QueryError
from tessera.session import Session
from tessera.sources.tables import table

SCHEMA = {
    "type": "object",
    "required": ["rec_id", "name", "mp", "category"],
    "properties": {"name": {"type": "string", "minLength": 1}, "mp": {"enum": ["", "0", "1", "2", "3", "4", "5"]}, "category": {"type": "string"}},
}

EXPORT = """
-- an empty text has no lines, as a missing one
MATCH {rec_id, source, card_type, alignment, name, mp, prowess, body, text}
WHERE source != null
ORDER BY [source, rec_id]
SAVE JSONL {rec_id, card_type, alignment, name, mp, prowess, body, text: CASE WHEN text == null OR text == "" THEN [] ELSE text.split("\\n") END} TO `feed/${source}.jsonl`;

WITH ["[1-9][0-9]?", "-"] AS line[] SAVE TEXT line TO "regex/prowess.txt";
WITH ["[1-9]", "10", "-"] AS line[] SAVE TEXT line TO "regex/body.txt";
"""

EXTRACT = """
-- every file of the feeds, with what is known of its source
LOAD JSONL FROM "extras.jsonl" AS extras
LOAD JSONL FROM `feed/${source}.jsonl` AS record
SET extra = extras[source]
CREATE {...record, ...extra, source};

CREATE INDEX by_name ON {set_name, name, alignment};
"""

TRANSFORM = """
MERGE {alignment: "Neutral"} INTO {alignment: null};
MERGE {mp: ""} INTO {mp: null};
MERGE {prowess: "-", body: "-"} INTO {card_type: "Hazard", prowess: null, body: null};

MATCH {rec_id, card_type: "Site", text: [line]}
MERGE {first: line} INTO {rec_id, card_type: "Site"};

DELETE {card_type: "Region"};
"""

LOAD = """
MATCH {card_type: "Character"} AS card
WITH card AS {rec_id, set_name, alignment, name, mp, prowess, body, category}
SAVE JSONL * TO "out/character.jsonl";

MATCH {card_type: "Hazard"} AS card
WITH card AS {rec_id, set_name, alignment, name, mp, prowess, body, category, strikes = 1}
SAVE JSONL * TO "out/hazard.jsonl";

DELETE _;

DROP INDEX by_name;
"""

VERIFY = """
LOAD JSONL FROM `out/${kind}.jsonl` AS card
CREATE card;

LOAD JSON FROM "schema.json" AS schema
SET @schema = schema;

-- records that don't validate
MATCH card
WHERE card IS NOT JSON(@schema)
RETURN {rec_id: card.rec_id, attr: "schema", value: card.mp}

UNION

-- values that match no line of their attribute's file
WITH ["prowess", "body"] AS attr[]
SET patterns = ARRAY(LOAD TEXT FROM `regex/${attr}.txt` AS pattern RETURN "^" + pattern + "$")
MATCH {[attr]: value} AS card
WHERE value != null
WHERE NOT EXISTS (WITH value, patterns AS pattern[] WHERE value.match(pattern))
RETURN {rec_id: card.rec_id, attr, value}
"""

MISSING = """
LOAD JSONL FROM `out/${kind}.jsonl` AS card
CREATE card;

-- names of the feeds that no file by kind holds
LOAD JSONL FROM `feed/${source}.jsonl` AS {name, rec_id}
WHERE name != null
WHERE NOT EXISTS (MATCH {name})
RETURN {rec_id, name, source}
"""

STEPS = (("extract", EXTRACT), ("transform", TRANSFORM), ("load", LOAD))


def workspace(spark: SparkSession) -> str:
    """A new folder that all executors see."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.removeprefix('file://').rstrip('/')}/tessera-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise QueryError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="tessera-")


_prepared: dict[tuple[str, str], str] = {}


def prepared(spark: SparkSession, d: str) -> str:
    """The folder with the files of the feeds and of what is known of their sources, made of the tables of d."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _prepared:
        base = workspace(spark)
        s = Session(spark, base=base)
        s.create(table(spark, d, "card").select("rec_id", "source", "card_type", "alignment", "name", "mp", "prowess", "body", "text"))
        s.query(EXPORT)
        # one object of all sources, a bounded list
        extras = {r["source"]: {"set_name": r["set_name"], "category": r["category"]} for r in table(spark, d, "source_file").collect()}
        for name, document in (("extras.jsonl", extras), ("schema.json", SCHEMA)):
            texts = Session(spark, base=base)
            texts.create(spark.createDataFrame([(json.dumps(document),)], "line string"))
            texts.query(f'MATCH {{line}} SAVE TEXT line TO "{name}"')
        _prepared[key] = base
    return _prepared[key]


def _after(spark: SparkSession, d: str, steps: int) -> Session:
    s = Session(spark, base=prepared(spark, d))
    for _, script in STEPS[:steps]:
        s.query(script)
    return s


def _texts(df: DataFrame) -> DataFrame:
    """Every column but rec_id as the text that it holds, rec_id as a number."""
    out = []
    for c, t in df.dtypes:
        kind = "bigint" if c == "rec_id" else "string"
        out.append((F.try_variant_get(c, "$", kind) if t == "variant" else F.col(c).cast(kind)).alias(c))
    return df.select(*out)


def workload_extract(spark: SparkSession, d: str) -> DataFrame:
    return _texts(_after(spark, d, 1).query("MATCH {rec_id, source, set_name, category, name, alignment} RETURN {rec_id, source, set_name, category, name, alignment}"))


def workload_transform(spark: SparkSession, d: str) -> DataFrame:
    return _texts(_after(spark, d, 2).query('MATCH {rec_id, alignment, mp, prowess, body, first = null} RETURN {rec_id, alignment, mp, prowess, body, first}'))


def workload_load(spark: SparkSession, d: str) -> DataFrame:
    return _texts(_after(spark, d, 3).query("LOAD JSONL FROM `out/${kind}.jsonl` AS {rec_id, name, mp, category, strikes = null} RETURN {kind, rec_id, name, mp, category, strikes}"))


def workload_verify(spark: SparkSession, d: str) -> DataFrame:
    return _texts(_after(spark, d, 3).query(VERIFY))


def workload_missing(spark: SparkSession, d: str) -> DataFrame:
    return _texts(_after(spark, d, 3).query(MISSING))


def load_jsonl_glob(spark: SparkSession, d: str) -> DataFrame:
    """The records of every file, in the order of its lines."""
    out = Session(spark, base=prepared(spark, d)).query("LOAD JSONL FROM `feed/${source}.jsonl` AS {rec_id} WITH source, rec_id[] AS ids RETURN {source, ids}")
    ids = F.from_json(F.to_json("ids"), "array<string>")
    return out.select("source", F.size(ids).cast("long").alias("n"), F.md5(F.array_join(ids, ",")).alias("in_order"))


def load_json(spark: SparkSession, d: str) -> DataFrame:
    return Session(spark, base=prepared(spark, d)).query('LOAD JSON FROM "schema.json" AS {required: field[], type} RETURN {field, type}').select(*[F.try_variant_get(c, "$", "string").alias(c) for c in ("field", "type")])


def load_text(spark: SparkSession, d: str) -> DataFrame:
    return Session(spark, base=prepared(spark, d)).query("LOAD TEXT FROM `regex/${attr}.txt` AS line RETURN {attr, line}")


def file_join(spark: SparkSession, d: str) -> DataFrame:
    """A bound variable in a path selects the files."""
    s = Session(spark, base=prepared(spark, d))
    return _texts(s.query('LOAD PARQUET FROM "' + d + '/source_file.parquet" AS {source, category: "Agents"} LOAD JSONL FROM `feed/${source}.jsonl` AS {rec_id} RETURN {source, rec_id}'))


def save_routed(spark: SparkSession, d: str) -> DataFrame:
    """Written under computed paths by Spark and read back."""
    base = workspace(spark)
    s = Session(spark, base=base)
    s.create(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"))
    s.query("MATCH {o_orderkey, o_orderstatus, o_orderpriority} ORDER BY [o_orderstatus, o_orderpriority] SAVE JSONL {o_orderkey} TO `by/${o_orderstatus}/${o_orderpriority}.jsonl`")
    got = s.query("LOAD JSONL FROM `by/${status}/${priority}.jsonl` AS {o_orderkey} RETURN {status, priority, o_orderkey}")
    return got.select("status", "priority", F.try_variant_get("o_orderkey", "$", "bigint").alias("o_orderkey"))


_FIXED = """c AS (SELECT rec_id, source, card_type, coalesce(alignment, 'Neutral') AS alignment, name, coalesce(mp, '') AS mp,
  CASE WHEN card_type = 'Hazard' AND prowess IS NULL AND body IS NULL THEN '-' ELSE prowess END AS prowess,
  CASE WHEN card_type = 'Hazard' AND prowess IS NULL AND body IS NULL THEN '-' ELSE body END AS body,
  coalesce(text, '') AS text FROM card WHERE card_type IS DISTINCT FROM 'Region' AND source IS NOT NULL)"""
_OUT = f"WITH {_FIXED}, o AS (SELECT c.*, category, lower(card_type) AS kind FROM c JOIN source_file USING (source) WHERE card_type IN ('Character', 'Hazard'))"

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "workload_extract": (workload_extract, "SELECT rec_id, source, set_name, category, name, alignment FROM (SELECT rec_id, source, name, alignment FROM card) c JOIN source_file USING (source)"),
    "workload_transform": (
        workload_transform,
        f"WITH {_FIXED} SELECT rec_id, alignment, mp, prowess, body, CASE WHEN card_type = 'Site' AND text <> '' THEN string_split(text, chr(10))[1] END AS first FROM c",
    ),
    "workload_load": (workload_load, f"{_OUT} SELECT kind, rec_id, name, mp, category, CASE WHEN kind = 'hazard' THEN '1' END AS strikes FROM o"),
    "workload_verify": (
        workload_verify,
        f"{_OUT} SELECT rec_id, 'schema' AS attr, mp AS value FROM o WHERE NOT (mp IN ('', '0', '1', '2', '3', '4', '5') AND coalesce(name, '') <> '') "
        "UNION ALL SELECT rec_id, 'prowess', prowess FROM o WHERE NOT regexp_full_match(prowess, '[1-9][0-9]?|-') UNION ALL SELECT rec_id, 'body', body FROM o WHERE NOT regexp_full_match(body, '[1-9]|10|-')",
    ),
    "workload_missing": (workload_missing, f"{_OUT} SELECT rec_id, name, source FROM card WHERE source IS NOT NULL AND name IS NOT NULL AND name NOT IN (SELECT name FROM o WHERE name IS NOT NULL)"),
    "load_jsonl_glob": (load_jsonl_glob, "SELECT source, count(*) AS n, md5(string_agg(CAST(rec_id AS VARCHAR), ',' ORDER BY CAST(rec_id AS VARCHAR) || ']')) AS in_order FROM card WHERE source IS NOT NULL GROUP BY source"),
    "load_json": (load_json, "SELECT unnest(['rec_id', 'name', 'mp', 'category']) AS field, 'object' AS type"),
    "load_text": (load_text, "SELECT * FROM (VALUES ('prowess', '[1-9][0-9]?'), ('prowess', '-'), ('body', '[1-9]'), ('body', '10'), ('body', '-')) v(attr, line)"),
    "file_join": (file_join, "SELECT source, rec_id FROM card JOIN source_file USING (source) WHERE category = 'Agents'"),
    "save_routed": (save_routed, "SELECT o_orderstatus AS status, o_orderpriority AS priority, o_orderkey FROM orders"),
}
