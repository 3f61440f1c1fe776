"""Smaller parts: schemas, quality reports, scraping, streams, the look of text."""

import json

from pyspark.sql import functions as F

from tessera.functions.schema_check import valid
from tessera.functions.textform import skeleton, skeleton_with_origin
from tessera.operators import quality
from tessera.sources.io import dump_jsonl, read_all_jsonl, read_jsonl
from tessera.sources.scrape import card_lines, keyed_lines, placed_lines, scraped
from tessera.streaming.matching import matched, told_apart


def test_schemas():
    s = {"definitions": {"n": {"type": "string", "minLength": 1}}, "allOf": [{"type": "object"}, {"required": ["a"], "properties": {"a": {"$ref": "#/definitions/n"}, "b": {"anyOf": [{"type": "null"}, {"enum": ["x", 1]}]}}, "propertyNames": {"enum": ["a", "b"]}}]}
    assert valid({"a": "v"}, s) and valid({"a": "v", "b": None}, s) and valid({"a": "v", "b": 1}, s)
    assert not any(valid(v, s) for v in ({}, {"a": ""}, {"a": "v", "c": 1}, {"a": "v", "b": True}, [], None))
    assert valid([1], {"items": {"const": 1}, "minItems": 1, "length": 9}) and not valid([], {"minItems": 1})
    assert valid(3, {"type": ["integer", "null"]}) and not valid(True, {"type": "number"}) and valid(2.0, {"type": "integer"})


def test_look_of_text():
    assert skeleton("Ｈook　Аnd") == skeleton("hook and") == "hook and"
    assert skeleton("é​") == skeleton("É")
    s, origin = skeleton_with_origin("a​  ﬁ")
    assert s == "a fi" and origin == [0, 2, 4, 4]


def test_quality(spark, rows):
    df = spark.createDataFrame([(1, "a", "x", ["p", "q"]), (2, "a", None, ["p1"]), (3, None, "y", None)], "id int, k string, v string, l array<string>")
    assert rows(quality.drill_down(df, "k")) == [("None", 1), ("a", 2), (None, 3)]
    assert rows(quality.conformance(df, {"v": ["# x", "x|z"], "l": ["[a-z]"]})) == [("l", 1, 2, '["p1"]'), ("v", 1, 2, "y")]
    assert rows(quality.conformance(df, {"v": ["x"]}, F.col("id").cast("string"))) == [("v", 1, 2, "y (3)")]
    assert rows(quality.nonconforming(df, "v", ["x"]), "id") == [(3,)]
    assert rows(quality.distinct_values(df, "l")) == [("p",), ("p1",), ("q",)]
    rules = {"r": (F.col("k") == "a", F.col("v") == "x")}
    assert rows(quality.rule_violations(df, rules)) == [("r", 2, 1)]
    assert rows(quality.violations(df, *rules["r"]), "id") == [(2,)]
    assert rows(quality.duplicate_groups(df, F.col("k"), "id")) == [("a", 2, 1, 2)]
    assert rows(quality.duplicate_rows(df, F.col("k")), "id") == [(1,), (2,)]
    assert rows(quality.formula_mismatches(df, "id", F.size("l").cast("int")), "id") == [(1,), (2,), (3,)]
    texts = spark.createDataFrame([('{"a": 1}',), ("{}",), ("no",), (None,)], "j string")
    assert rows(quality.schema_errors(texts, F.col("j"), {"required": ["a"]})) == [("no",), ("{}",), (None,)]
    assert quality.drill_down(df.limit(0), "k").where("k is not null").collect() == []


SHOP = "<section><h3>Lamp</h3><p>PRICE: 12</p><p>TAGS: oil,brass</p>Burns <em>all</em> night<p>SIZE: tall</p></section><h3>Rope</h3>ten yards"


def test_scraping_by_keys(spark):
    assert card_lines(SHOP, "h3")[1] == ["Rope", "ten yards"]
    df = spark.createDataFrame([(1, SHOP), (2, None), (3, "<p>nothing</p>")], "id int, html string")
    layout = keyed_lines(("PRICE", "TAGS"), "item", "about", ("TAGS",), ",")
    got = {(r["id"], r["card_no"]): json.loads(r["a"]) for r in scraped(df, "id", "html", "h3", layout).select("id", "card_no", F.to_json("attributes").alias("a")).collect()}
    assert got == {(1, 0): {"item": "Lamp", "about": "Burns all night SIZE: tall", "PRICE": "12", "TAGS": ["oil", "brass"]}, (1, 1): {"item": "Rope", "about": "ten yards"}}


def test_scraping_by_places(spark):
    page = "<ul><li class=head>Item</li><li class=ware>Lamp</li>12</ul><ul><li class=ware>Rope</li>x</ul><li class=ware>Pot</li>"
    layout = placed_lines({"item": lambda x: x[0], "price": lambda x: int(x[1])}, (2,))
    out = scraped(spark.createDataFrame([(1, page)], "id int, html string"), "id", "html", lambda name, attrs, inner: attrs.get("class") == "ware", layout)
    got = {r["card_no"]: (r["a"] and json.loads(r["a"]), r["error"]) for r in out.select("card_no", F.to_json("attributes").alias("a"), "error").collect()}
    assert got[0] == ({"item": "Lamp", "price": 12}, None)
    assert got[1][0] is None and got[1][1].startswith("ValueError") and got[2][1] == "ValueError: 1 lines, expected 2"


def test_jsonl_functions(spark, tmp_path, rows):
    dump_jsonl(spark.createDataFrame([(1, "a")], "k int, v string"), str(tmp_path / "a.jsonl"))
    (tmp_path / "index.jsonl").write_text("{}\n")
    assert rows(read_jsonl(spark, str(tmp_path / "a.jsonl")).select(F.to_json("doc"))) == [('{"k":1,"v":"a"}',)]
    assert read_all_jsonl(spark, str(tmp_path)).count() == 1


def test_streams_give_what_batches_give(spark, tmp_path, rows):
    src = tmp_path / "in"
    spark.createDataFrame([('{"a": 1, "b": ["x"]}', "1,2,3,4,5,,,8,9"), ('{"b": []}', "1,2")], "j string, raw string").write.parquet(str(src))
    stream = spark.readStream.schema("j string, raw string").parquet(str(src))
    out = matched(stream, "{a, b: [first]}", "j").selectExpr("to_json(a) a", "to_json(first) f")
    q = out.writeStream.format("memory").queryName("m").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("m")) == [("1", '"x"')]
    q = told_apart(stream, "raw").select("reason", F.size("cells").alias("n")).writeStream.format("memory").queryName("t").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("t")) in ([("columns", None), (None, 9)], [("columns", -1), (None, 9)])
