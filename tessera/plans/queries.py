"""The registered queries of the query language and of the quality reports; each takes (spark, directory of the tables).

Every query runs over its whole tables. The scripts are written in the language; what follows a script only gives the
columns plain types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import quality
from tessera.operators.untemplate import untemplated
from tessera.plans import workload
from tessera.session import Session
from tessera.sources.tables import table

QueryFunction = Callable[[SparkSession, str], DataFrame]

#: name -> (script, SQL). {d} is the directory; tables are documents of the typed lane.
SCRIPTS: dict[str, tuple[str, str]] = {
    # patterns
    "match_literal": (
        'LOAD PARQUET FROM "{d}/orders.parquet" AS {o_orderstatus: "F", o_orderkey, o_custkey}',
        "SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F'",
    ),
    "match_null_safe": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {card_class: null, rec_id, card_type} RETURN {rec_id, card_type}',
        "SELECT rec_id, card_type FROM card WHERE card_class IS NULL",
    ),
    "match_default": (
        'LOAD PARQUET FROM "{d}/part.parquet" AS {p_partkey, p_color: color = "none", p_size: size = 0} RETURN {p_partkey, color, size}',
        "SELECT p_partkey, 'none' AS color, p_size AS size FROM part",
    ),
    "match_rest": (
        'LOAD PARQUET FROM "{d}/supplier.parquet" AS {s_suppkey, ...other} RETURN {s_suppkey, name: other.s_name, nation: other.s_nationkey}',
        "SELECT s_suppkey, s_name AS name, s_nationkey AS nation FROM supplier",
    ),
    "match_alias": (
        'LOAD PARQUET FROM "{d}/nation.parquet" AS {n_regionkey: 1 AS region, n_name AS name} AS n RETURN {region, name, key: n.n_nationkey}',
        "SELECT 1 AS region, n_name AS name, n_nationkey AS key FROM nation WHERE n_regionkey = 1",
    ),
    "match_repeat_var": (
        'LOAD PARQUET FROM "{d}/lineitem.parquet" AS {l_linenumber: x, l_suppkey: x, l_orderkey} RETURN {l_orderkey, x}',
        "SELECT l_orderkey, l_linenumber AS x FROM lineitem WHERE l_linenumber IS NOT DISTINCT FROM l_suppkey",
    ),
    "dotted_variable": (
        'LOAD PARQUET FROM "{d}/region.parquet" AS {r_regionkey: r.id, r_name: r.name} RETURN {id: r.id, name: r.name}',
        "SELECT r_regionkey AS id, r_name AS name FROM region",
    ),
    "unwind": (
        'LOAD PARQUET FROM "{d}/map_region.parquet" AS {name, adjacent_regions: next[]}',
        "SELECT name, unnest(adjacent_regions) AS next FROM map_region",
    ),
    "unwind_twice": (
        'LOAD PARQUET FROM "{d}/map_region.parquet" AS {name, adjacent_regions: a[]} LOAD PARQUET FROM "{d}/map_region.parquet" AS {name: a, adjacent_regions: b[]}',
        "SELECT x.name, x.a, unnest(y.adjacent_regions) AS b FROM (SELECT name, unnest(adjacent_regions) AS a FROM map_region) x JOIN map_region y ON y.name = x.a",
    ),
    "unwind_two_arrays": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {rec_id, skills, name} WHERE skills != null AND name != null WITH rec_id, skills.split(", ") AS s[], name.split(" ") AS n[] RETURN {rec_id, s, n}',
        "SELECT rec_id, s, unnest(string_split(name, ' ')) AS n FROM (SELECT rec_id, name, unnest(string_split(skills, ', ')) AS s FROM card WHERE skills IS NOT NULL AND name IS NOT NULL)",
    ),
    "star": (
        'LOAD PARQUET FROM "{d}/supplier.parquet" AS {s_suppkey: id, s_name: name} WITH *, 7 AS seven RETURN {id, name, seven}',
        "SELECT s_suppkey AS id, s_name AS name, 7 AS seven FROM supplier",
    ),
    "unwind_split": (
        'LOAD PARQUET FROM "{d}/documents.parquet" AS {doc_id, source: "ruling", text} WHERE text != null WITH doc_id, text.split("\\n") AS line[] WHERE line != "" RETURN {doc_id, line}',
        "SELECT * FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE source = 'ruling' AND text IS NOT NULL) WHERE line <> ''",
    ),
    "unpack": (
        'LOAD PARQUET FROM "{d}/nation.parquet" AS {n_nationkey: id, ...rest} WITH id, rest AS {[key]: value} SET value = CASE WHEN key == "n_name" THEN "name" ELSE "number" END RETURN {id, key, value}',
        "SELECT n_nationkey AS id, k AS key, CASE WHEN k = 'n_name' THEN 'name' ELSE 'number' END AS value FROM nation, (VALUES ('n_name'), ('n_regionkey')) v(k)",
    ),
    "tuple_prefix": (
        'LOAD PARQUET FROM "{d}/embeddings.parquet" AS {vec_id, embedding: [first, second]}',
        "SELECT vec_id, embedding[1] AS first, embedding[2] AS second FROM embeddings WHERE len(embedding) >= 2",
    ),
    "template_match": (
        'LOAD PARQUET FROM "{d}/customer.parquet" AS {c_custkey, c_name: `Customer#${number}`}',
        "SELECT c_custkey, c_name[10:] AS number FROM customer WHERE starts_with(c_name, 'Customer#')",
    ),
    # joins
    "join_natural": (
        'LOAD PARQUET FROM "{d}/orders.parquet" AS {o_custkey: k, o_orderkey, o_orderstatus: "F"} LOAD PARQUET FROM "{d}/customer.parquet" AS {c_custkey: k, c_mktsegment: "BUILDING"} RETURN {o_orderkey, k}',
        "SELECT o_orderkey, o_custkey AS k FROM orders JOIN customer ON o_custkey IS NOT DISTINCT FROM c_custkey WHERE o_orderstatus = 'F' AND c_mktsegment = 'BUILDING'",
    ),
    "join_three_way": (
        'LOAD PARQUET FROM "{d}/orders.parquet" AS {o_custkey: k, o_orderkey} LOAD PARQUET FROM "{d}/customer.parquet" AS {c_custkey: k, c_nationkey: n} LOAD PARQUET FROM "{d}/nation.parquet" AS {n_nationkey: n, n_name} RETURN {o_orderkey, n_name}',
        "SELECT o_orderkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    ),
    "join_null_keys": (
        'LOAD PARQUET FROM "{d}/card_set.parquet" AS {set_name: s, set_code} LOAD PARQUET FROM "{d}/card.parquet" AS {set_name: s, rec_id} RETURN {rec_id, set_code}',
        "SELECT rec_id, set_code FROM card JOIN card_set ON card.set_name IS NOT DISTINCT FROM card_set.set_name",
    ),
    "join_product": (
        'LOAD PARQUET FROM "{d}/region.parquet" AS {r_name: a} LOAD PARQUET FROM "{d}/region.parquet" AS {r_name: b}',
        "SELECT x.r_name AS a, y.r_name AS b FROM region x CROSS JOIN region y",
    ),
    "lookup_object": (
        'LOAD PARQUET FROM "{d}/nation.parquet" AS {n_name, n_regionkey} SET labels = {a: "Africa", b: "other"} SET key = CASE n_regionkey WHEN 0 THEN "a" ELSE "b" END RETURN {n_name, label: labels[key]}',
        "SELECT n_name, CASE WHEN n_regionkey = 0 THEN 'Africa' ELSE 'other' END AS label FROM nation",
    ),
    "exists_semi": (
        'LOAD PARQUET FROM "{d}/orders.parquet" AS {o_orderkey: k, o_orderpriority} WHERE EXISTS(LOAD PARQUET FROM "{d}/lineitem.parquet" AS {l_orderkey: k, l_returnflag: "R"}) RETURN {k, o_orderpriority}',
        "SELECT o_orderkey AS k, o_orderpriority FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')",
    ),
    "not_exists_anti": (
        'LOAD PARQUET FROM "{d}/customer.parquet" AS {c_custkey: k, c_name} WHERE NOT EXISTS(LOAD PARQUET FROM "{d}/orders.parquet" AS {o_custkey: k, o_orderpriority: "1-URGENT"}) RETURN {k, c_name}',
        "SELECT c_custkey AS k, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')",
    ),
    "regex_anti": (
        'LOAD PARQUET FROM "{d}/part.parquet" AS {p_partkey, p_type} SET patterns = ["^ECO", "BRASS$"] WHERE NOT EXISTS(WITH p_type, patterns AS pattern[] WHERE p_type.match(pattern)) RETURN {p_partkey, p_type}',
        "SELECT p_partkey, p_type FROM part WHERE NOT (regexp_matches(p_type, '^ECO') OR regexp_matches(p_type, 'BRASS$'))",
    ),
    "array_subquery": (
        'LOAD PARQUET FROM "{d}/nation.parquet" AS {n_nationkey: n, n_name} SET suppliers = ARRAY(LOAD PARQUET FROM "{d}/supplier.parquet" AS {s_nationkey: n, s_name} ORDER BY s_name RETURN s_name) RETURN {n_name, suppliers: suppliers.join("|")}',
        "SELECT n_name, coalesce((SELECT string_agg(s_name, '|' ORDER BY s_name) FROM supplier WHERE s_nationkey = n_nationkey), '') AS suppliers FROM nation",
    ),
    "array_local": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {rec_id, adjacent_regions: a} WHERE a != null SET b = ARRAY(WITH a AS x[] WHERE x.includes(" ") RETURN x.replace(" ", "_")) RETURN {rec_id, b: b.join(",")}',
        "SELECT rec_id, coalesce(array_to_string(list_transform(list_filter(adjacent_regions, lambda x: contains(x, ' ')), lambda x: replace(x, ' ', '_')), ','), '') AS b FROM card WHERE adjacent_regions IS NOT NULL",
    ),
    # expressions
    "template_build": (
        'LOAD PARQUET FROM "{d}/part.parquet" AS {p_partkey, p_brand, p_type} RETURN {p_partkey, label: `${p_brand}: ${p_type}!`}',
        "SELECT p_partkey, p_brand || ': ' || p_type || '!' AS label FROM part",
    ),
    "replace": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {rec_id, text} WHERE text != null RETURN {rec_id, text: text.replace("\\n", " ").replace("the ", "")}',
        "SELECT rec_id, replace(replace(text, chr(10), ' '), 'the ', '') AS text FROM card WHERE text IS NOT NULL",
    ),
    "split_join": (
        'LOAD PARQUET FROM "{d}/part.parquet" AS {p_partkey, p_name} RETURN {p_partkey, name: p_name.split(" ").join("-"), letters: p_name.split("").join(".")}',
        "SELECT p_partkey, replace(p_name, ' ', '-') AS name, array_to_string(list_filter(string_split(p_name, ''), lambda x: x <> ''), '.') AS letters FROM part",
    ),
    "includes_str": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {rec_id, text} WHERE text != null AND text.includes("Captain") RETURN rec_id',
        "SELECT rec_id AS value FROM card WHERE contains(text, 'Captain')",
    ),
    "includes_list": (
        'LOAD PARQUET FROM "{d}/orders.parquet" AS {o_orderkey, o_orderpriority} WHERE ["1-URGENT", "2-HIGH"].includes(o_orderpriority) RETURN {o_orderkey}',
        "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    ),
    "includes_key": (
        'LOAD PARQUET FROM "{d}/region.parquet" AS r RETURN {name: r.r_name, a: r.includes("r_name"), b: r.includes("r_comment")}',
        "SELECT r_name AS name, true AS a, false AS b FROM region",
    ),
    "trim": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {rec_id, race} WHERE race != null RETURN {rec_id, race: race.trim()}',
        "SELECT rec_id, trim(race, ' ' || chr(9) || chr(10) || chr(13)) AS race FROM card WHERE race IS NOT NULL",
    ),
    "match_groups": (
        'LOAD PARQUET FROM "{d}/customer.parquet" AS {c_custkey, c_name} SET m = c_name.match("([A-Z])[a-z]+#0*([1-9][0-9]*)") WHERE m RETURN {c_custkey, a: m[1], b: m[2]}',
        "SELECT c_custkey, regexp_extract(c_name, '([A-Z])[a-z]+#0*([1-9][0-9]*)', 1) AS a, regexp_extract(c_name, '([A-Z])[a-z]+#0*([1-9][0-9]*)', 2) AS b FROM customer WHERE regexp_matches(c_name, '([A-Z])[a-z]+#0*([1-9][0-9]*)')",
    ),
    "add_numeric": (
        'LOAD PARQUET FROM "{d}/lineitem.parquet" AS {l_orderkey, l_linenumber, l_suppkey} RETURN {l_orderkey, s: l_linenumber + l_suppkey + 1}',
        "SELECT l_orderkey, CAST(l_linenumber + l_suppkey + 1 AS BIGINT) AS s FROM lineitem",
    ),
    "add_string": (
        'LOAD PARQUET FROM "{d}/customer.parquet" AS {c_custkey, c_name, c_mktsegment} RETURN {c_custkey, s: c_name + "/" + c_mktsegment}',
        "SELECT c_custkey, c_name || '/' || c_mktsegment AS s FROM customer",
    ),
    "add_array": (
        'LOAD PARQUET FROM "{d}/map_region.parquet" AS {name, adjacent_regions: a} SET b = a + [name] RETURN {name, b: b.join(",")}',
        "SELECT name, array_to_string(list_append(adjacent_regions, name), ',') AS b FROM map_region",
    ),
    "element": (
        'LOAD PARQUET FROM "{d}/map_region.parquet" AS {name, adjacent_regions: a} RETURN {name, first: a[0], last: a[-1], letter: name[0]}',
        "SELECT name, adjacent_regions[1] AS first, adjacent_regions[-1] AS last, name[1] AS letter FROM map_region",
    ),
    "property": (
        'LOAD PARQUET FROM "{d}/supplier.parquet" AS s RETURN {key: s.s_suppkey, name: s.s_name}',
        "SELECT s_suppkey AS key, s_name AS name FROM supplier",
    ),
    "spread": (
        'LOAD PARQUET FROM "{d}/nation.parquet" AS n SET m = {...n, n_name: "x", extra: n.n_name} RETURN {...m, n_regionkey: 7}',
        "SELECT n_nationkey, 'x' AS n_name, n_name AS extra, 7 AS n_regionkey FROM nation",
    ),
    "array_spread": (
        'LOAD PARQUET FROM "{d}/map_region.parquet" AS {name, adjacent_regions: a} SET b = ["<", ...a, ">"] RETURN {name, b: b.join("")}',
        "SELECT name, '<' || array_to_string(adjacent_regions, '') || '>' AS b FROM map_region",
    ),
    "case_bool": (
        'LOAD PARQUET FROM "{d}/orders.parquet" AS {o_orderkey, o_orderstatus: s, o_orderpriority: p} RETURN {o_orderkey, c: CASE WHEN s == "F" AND p == "1-URGENT" THEN "a" WHEN s == "O" THEN "b" END}',
        "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'a' WHEN o_orderstatus = 'O' THEN 'b' END AS c FROM orders",
    ),
    "case_match": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {rec_id, alignment} RETURN {rec_id, c: CASE alignment WHEN "Hero" THEN 1 WHEN null THEN 2 ELSE 3 END}',
        "SELECT rec_id, CASE WHEN alignment = 'Hero' THEN 1 WHEN alignment IS NULL THEN 2 ELSE 3 END AS c FROM card",
    ),
    "truthy_where": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {rec_id, skills, keyed_to} WHERE skills WHERE NOT keyed_to RETURN rec_id',
        "SELECT rec_id AS value FROM card WHERE coalesce(skills, '') <> '' AND coalesce(len(keyed_to), 0) = 0",
    ),
    "and_or_precedence": (
        'LOAD PARQUET FROM "{d}/orders.parquet" AS {o_orderkey, o_orderstatus: s, o_orderpriority: p} WHERE s == "F" AND p == "1-URGENT" OR p == "2-HIGH" RETURN {o_orderkey}',
        "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND (o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH')",
    ),
    "not_precedence": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {rec_id, race, card_class} SET no = "" == "x" RETURN {rec_id, t: NOT race == no}',
        "SELECT rec_id, (coalesce(race, '') = '') = false AS t FROM card",
    ),
    "eq_null": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {rec_id, mp, mind} WHERE mp == mind RETURN {rec_id}',
        "SELECT rec_id FROM card WHERE mp IS NOT DISTINCT FROM mind",
    ),
    # ordering, sets
    "distinct": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {card_type, alignment} RETURN DISTINCT {card_type, alignment}',
        "SELECT DISTINCT card_type, alignment FROM card",
    ),
    "union_all": (
        'LOAD PARQUET FROM "{d}/customer.parquet" AS {c_nationkey: n, c_name: name} UNION LOAD PARQUET FROM "{d}/supplier.parquet" AS {s_nationkey: n, s_name: name}',
        "SELECT c_nationkey AS n, c_name AS name FROM customer UNION ALL SELECT s_nationkey, s_name FROM supplier",
    ),
    # aggregation
    "collect_sorted": (
        'LOAD PARQUET FROM "{d}/supplier.parquet" AS {s_nationkey: n, s_name} ORDER BY [n, s_name] WITH n, s_name[] AS names RETURN {n, names: names.join("|")}',
        "SELECT s_nationkey AS n, string_agg(s_name, '|' ORDER BY s_name) AS names FROM supplier GROUP BY s_nationkey",
    ),
    "regroup": (
        'LOAD PARQUET FROM "{d}/map_region.parquet" AS {name, adjacent_regions: a[]} SET a = a.replace(" ", "_") WITH name, a[] AS b RETURN {name, b: b.join(",")}',
        "SELECT name, replace(array_to_string(adjacent_regions, ','), ' ', '_') AS b FROM map_region WHERE len(adjacent_regions) > 0",
    ),
    # the record store
    "create_match": (
        'LOAD PARQUET FROM "{d}/nation.parquet" AS n CREATE n; LOAD PARQUET FROM "{d}/region.parquet" AS {r_regionkey: n_regionkey, r_name: n_name} CREATE {n_name, n_regionkey}; MATCH {n_name, n_regionkey} RETURN {n_name, n_regionkey}',
        "SELECT n_name, n_regionkey FROM nation UNION ALL SELECT r_name, r_regionkey FROM region",
    ),
    "merge_const": (
        'LOAD PARQUET FROM "{d}/card.parquet" AS {rec_id, mp, mind} CREATE {rec_id, mp, mind}; MERGE {mp: ""} INTO {mp: null}; MERGE {mp: "none"} INTO {mp: "0"}; MATCH {rec_id, mp, mind} RETURN {rec_id, mp, mind}',
        "SELECT rec_id, CASE WHEN mp IS NULL THEN '' WHEN mp = '0' THEN 'none' ELSE mp END AS mp, mind FROM card",
    ),
    "merge_join": (
        'LOAD PARQUET FROM "{d}/nation.parquet" AS n CREATE n; LOAD PARQUET FROM "{d}/region.parquet" AS {r_regionkey: k, r_name: n_name} WHERE k != 2 MERGE {n_name} INTO {n_regionkey: k}; MATCH {n_nationkey, n_name} RETURN {n_nationkey, n_name}',
        "SELECT n_nationkey, CASE WHEN n_regionkey <> 2 THEN r_name ELSE n_name END AS n_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    ),
    "merge_grouped": (
        'LOAD PARQUET FROM "{d}/map_region.parquet" AS r CREATE r; MATCH {name, adjacent_regions: line[]} SET line = line + "." MERGE {adjacent_regions: line[]} INTO {name}; MATCH {name, adjacent_regions: a} RETURN {name, a: a.join(",")}',
        "SELECT name, array_to_string(list_transform(adjacent_regions, lambda x: x || '.'), ',') AS a FROM map_region",
    ),
    "delete": (
        'LOAD PARQUET FROM "{d}/supplier.parquet" AS s CREATE s; DELETE {s_nationkey: 3}; LOAD PARQUET FROM "{d}/nation.parquet" AS {n_regionkey: 1, n_nationkey: k} DELETE {s_nationkey: k}; MATCH {s_suppkey, s_nationkey} RETURN {s_suppkey, s_nationkey}',
        "SELECT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey <> 3 AND s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)",
    ),
    "set_global": (
        'LOAD PARQUET FROM "{d}/region.parquet" AS {r_regionkey: 3, r_name} SET @home = r_name; LOAD PARQUET FROM "{d}/nation.parquet" AS {n_name, n_regionkey: 3} RETURN {n_name, home: @home}',
        "SELECT n_name, (SELECT r_name FROM region WHERE r_regionkey = 3) AS home FROM nation WHERE n_regionkey = 3",
    ),
    "index": (
        'LOAD PARQUET FROM "{d}/nation.parquet" AS n CREATE n; CREATE INDEX by_name ON {n_name}; MATCH {n_nationkey: 3, n_name} WITH n_name MATCH {n_name, n_regionkey} RETURN {n_name, n_regionkey}',
        "SELECT n_name, n_regionkey FROM nation WHERE n_nationkey = 3",
    ),
}

def _scripted(name: str) -> QueryFunction:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return Session(spark).query(SCRIPTS[name][0].replace("{d}", d))

    run.__name__ = name
    return run


def json_props(spark: SparkSession, d: str) -> DataFrame:
    """The variant lane: JSON texts as documents of a record store."""
    session = Session(spark)
    session.create(table(spark, d, "events").select("event_id", F.try_parse_json("props").alias("props")))
    out = session.query("MATCH {event_id, props: {k: number, x = null}} RETURN {event_id, number, x}")
    return out.select("event_id", F.try_variant_get("number", "$", "bigint").alias("number"), F.is_variant_null("x").alias("no_x"))


def collect_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of events of one kind in the order of time: adjacent rows group, equal keys that aren't adjacent don't."""
    session = Session(spark)
    session.create(table(spark, d, "events").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")))
    out = session.query("MATCH {event_id, ts, event_type: t} ORDER BY ts WITH t, event_id[] AS ids RETURN {t, ids}")
    return out.select("t", F.array_min("ids").alias("lowest"), F.size("ids").cast("long").alias("n"))


def order_json_text(spark: SparkSession, d: str) -> DataFrame:
    """Rows in the order of the JSON text of a number, with their places."""
    out = Session(spark).query(f'LOAD PARQUET FROM "{d}/nation.parquet" AS {{n_nationkey, n_regionkey}} ORDER BY [n_regionkey, n_nationkey] WITH n_nationkey[] AS keys RETURN {{keys}}')
    return out.select(F.posexplode("keys").alias("place", "n_nationkey")).select(F.col("place").cast("long").alias("place"), "n_nationkey")


def drill_down(spark: SparkSession, d: str) -> DataFrame:
    return quality.drill_down(table(spark, d, "card"), "card_type", "alignment")


def conformance(spark: SparkSession, d: str) -> DataFrame:
    patterns = {"mp": [r"[1-9]\*?", r"-[1-9]", r"[0-9]?\([1-9]\)", ""], "mind": ["[1-9]|10|-1", ""], "alignment": ["Hero", "Minion"]}
    return quality.conformance(table(spark, d, "card"), patterns)


def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    return quality.distinct_values(table(spark, d, "map_region"), "adjacent_regions")


def rule_violations(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    rules = {
        "agents are hazards": (c("card_class") == "Agent", c("card_type") == "Hazard"),
        "characters have a race": (c("card_type") == "Character", c("race").isNotNull()),
        "delivered after issue": (F.lit(True), c("loaded_at") >= c("issued_at")),
    }
    return quality.rule_violations(table(spark, d, "card"), rules)


def duplicates(spark: SparkSession, d: str) -> DataFrame:
    summary = F.concat_ws("/", "set_name", "name", F.coalesce("alignment", F.lit("-")))
    return quality.duplicate_groups(table(spark, d, "card"), summary, "source")


def formula_check(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_linenumber").alias("total"), F.count("*").alias("n"))
    return quality.formula_mismatches(lines, "total", F.ceil(F.col("n") * (F.col("n") + 1) / 2).cast("long")).select("l_orderkey", "total", "calculated")


_PROPS = '{type: "object", required: ["k"], properties: {k: {type: "integer", minimum: 5}}}'


def schema_valid(spark: SparkSession, d: str) -> DataFrame:
    """IS JSON and IS NOT JSON of the language."""
    session = Session(spark)
    session.create(table(spark, d, "events").select("event_id", F.parse_json("props").alias("props")))
    out = session.query(f"SET @schema = {_PROPS}; MATCH {{event_id, props}} RETURN {{event_id, valid: props IS JSON(@schema), wrong: props IS NOT JSON(@schema)}}")
    return out.select("event_id", "valid", "wrong")


def untemplate_lists(spark: SparkSession, d: str) -> DataFrame:
    """Pages with a loop, an if within it, a safe part and both filters, taken apart again."""
    n = table(spark, d, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_name")).alias("names"))
    items = F.array_join(F.transform("names", lambda x: F.concat(F.lit("<li>"), x, F.when(x > "J", F.lit("<i>late</i>")).otherwise(""), F.lit("</li>"))), "")
    page = F.concat(F.lit("<h2>Reg. "), F.col("n_regionkey").cast("string"), F.lit("</h2><p><b>bold</b> text</p><ul>"), items, F.lit("</ul>ALL: "), F.array_join("names", "/"), F.lit("<hr>"))
    template = "<h2>{{ region.title|replace('Region', 'Reg.') }}</h2><p>{{ region.about|safe }}</p><ul>{% for x in region.nations %}<li>{{ x.name }}{% if x.late %}<i>late</i>{% endif %}</li>{% endfor %}</ul>ALL: {{ region.all|join('/') }}<hr>"
    got = untemplated(n.select("n_regionkey", page.alias("html")), "n_regionkey", "html", template)
    text = lambda p: F.try_variant_get("result", p, "string")
    inner = F.from_json(F.to_json("result"), "region struct<nations:array<struct<name:string,late:boolean>>,`all`:array<string>>")
    one = got.select("n_regionkey", "ok", text("$.region.title").alias("title"), text("$.region.about").alias("about"), inner.alias("r"))
    return one.select("n_regionkey", "ok", "title", "about", F.size("r.region.all").cast("long").alias("n_all"), F.explode("r.region.nations").alias("x")).select("n_regionkey", "ok", "title", "about", "n_all", "x.name", "x.late")


def untemplate_cards(spark: SparkSession, d: str) -> DataFrame:
    """Every card as a small page, taken apart again by the template that could have made it."""
    card = table(spark, d, "card").where("name is not null").select("rec_id", "name", "card_type", "text")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(F.lit("<h2>"), esc(F.col("name")), F.lit("</h2>\nTYPE: "), F.col("card_type"), F.lit("<br>"), F.coalesce(F.concat(F.lit("TEXT: "), esc(F.col("text")), F.lit("<BR>")), F.lit("")))
    template = "<h2>{{ card.name }}</h2>TYPE: {{ card.type }}<br>{% if card.text is not none %}{{ 'TEXT: ' }}{{ card.text }}<br>{% endif %}"
    got = untemplated(card.select("rec_id", page.alias("html")), "rec_id", "html", template)
    text = lambda p: F.try_variant_get("result", p, "string")
    return got.select("rec_id", "ok", text("$.card.name").alias("name"), text("$.card.type").alias("type"), text("$.card.text").alias("text"))


FUNCTIONS: dict[str, tuple[QueryFunction, str]] = {
    "json_props": (json_props, "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS number, true AS no_x FROM events WHERE json_extract(props, '$.k') IS NOT NULL"),
    "collect_runs": (
        collect_runs,
        "WITH o AS (SELECT event_id, event_type, row_number() OVER (ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), event_id) AS n FROM events), "
        "g AS (SELECT *, CASE WHEN lag(event_type) OVER (ORDER BY n) = event_type THEN 0 ELSE 1 END AS s FROM o), "
        "r AS (SELECT *, sum(s) OVER (ORDER BY n) AS run FROM g) SELECT event_type AS t, min(event_id) AS lowest, count(*) AS n FROM r GROUP BY run, event_type",
    ),
    "order_json_text": (
        order_json_text,
        "SELECT row_number() OVER (ORDER BY '[' || n_regionkey || ', ' || n_nationkey || ']') - 1 AS place, n_nationkey FROM nation",
    ),
    "drill_down": (
        drill_down,
        "SELECT card_type, alignment, count(*) AS n FROM (SELECT coalesce(card_type, 'None') AS card_type, coalesce(alignment, 'None') AS alignment FROM card) GROUP BY ROLLUP (card_type, alignment)",
    ),
    "conformance": (
        conformance,
        "WITH v AS (SELECT 'mp' AS attribute, mp AS x, regexp_full_match(mp, '([1-9]\\*?)|(-[1-9])|([0-9]?\\([1-9]\\))|') AS ok FROM card UNION ALL "
        "SELECT 'mind', mind, regexp_full_match(mind, '([1-9]|10|-1)|') FROM card UNION ALL SELECT 'alignment', alignment, alignment IN ('Hero', 'Minion') FROM card) "
        "SELECT attribute, count(*) FILTER (ok) AS passed, count(*) AS total, min(x) FILTER (NOT ok) AS example FROM v WHERE x IS NOT NULL GROUP BY attribute",
    ),
    "distinct_values": (distinct_values, "SELECT DISTINCT unnest(adjacent_regions) AS value FROM map_region"),
    "rule_violations": (
        rule_violations,
        "SELECT 'agents are hazards' AS rule, count(*) FILTER (card_class = 'Agent') AS n_checked, count(*) FILTER (card_class = 'Agent' AND card_type <> 'Hazard') AS n_failed FROM card UNION ALL "
        "SELECT 'characters have a race', count(*) FILTER (card_type = 'Character'), count(*) FILTER (card_type = 'Character' AND race IS NULL) FROM card UNION ALL "
        "SELECT 'delivered after issue', count(*), count(*) FILTER (NOT coalesce(loaded_at >= issued_at, false)) FROM card",
    ),
    "duplicates": (
        duplicates,
        "SELECT concat_ws('/', set_name, name, coalesce(alignment, '-')) AS summary, count(*) AS n, min(source) AS first_name, max(source) AS last_name FROM card GROUP BY 1 HAVING count(*) > 1",
    ),
    "formula_check": (
        formula_check,
        "SELECT * FROM (SELECT l_orderkey, CAST(sum(l_linenumber) AS BIGINT) AS total, CAST(ceil(count(*) * (count(*) + 1) / 2) AS BIGINT) AS calculated FROM lineitem GROUP BY l_orderkey) WHERE total <> calculated",
    ),
    "schema_valid": (schema_valid, "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) >= 5 AS valid, CAST(json_extract(props, '$.k') AS BIGINT) < 5 AS wrong FROM events"),
    "untemplate_lists": (
        untemplate_lists,
        "SELECT n_regionkey, true AS ok, 'Region ' || n_regionkey AS title, '<b>bold</b> text' AS about, count(*) OVER (PARTITION BY n_regionkey) AS n_all, n_name AS name, n_name > 'J' AS late FROM nation",
    ),
    "untemplate_cards": (
        untemplate_cards,
        r"SELECT rec_id, true AS ok, regexp_replace(name, '^\s+|\s+$', '', 'g') AS name, card_type AS type, regexp_replace(text, '\s+$', '') AS text FROM card WHERE name IS NOT NULL",
    ),
}


def queries() -> dict[str, QueryFunction]:
    return {**{n: f for n, (f, _) in workload.QUERIES.items()}, **{n: _scripted(n) for n in SCRIPTS}, **{n: f for n, (f, _) in FUNCTIONS.items()}}


def oracle_sql() -> dict[str, str]:
    return {**{n: s for n, (_, s) in workload.QUERIES.items()}, **{n: s for n, (_, s) in SCRIPTS.items()}, **{n: s for n, (_, s) in FUNCTIONS.items()}}

