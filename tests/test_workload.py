"""The workload on odd records against its SQL."""

import json

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_entry import canonical

from tessera.functions import values as V
from tessera.plans import frame, workload
from tessera.session import Session

TEXTS = ["", None, "\n", "\nsecond", "one", "one\ntwo", " ", "a \"quoted\" line\né"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("odd"))
    cards = [(i, "s1" if i % 2 else "s2", kind, None if i % 3 else "Hero", f"n{i}", None if i % 5 else "2", text) for i, (kind, text) in enumerate((k, t) for k in ("Site", "Hazard", "Region", None) for t in TEXTS)]
    cards.append((900, None, "Site", "Hero", "no source", "1", "line"))
    df = spark.createDataFrame(cards, "rec_id long, source string, card_type string, alignment string, name string, mp string, text string")
    some = F.when(F.col("rec_id") % 3 > 0, "7"), F.when(F.col("rec_id") % 4 > 1, "5")
    df.withColumns({"prowess": some[0], "body": some[1]}).write.parquet(f"{d}/card.parquet")
    spark.createDataFrame([("s1", "Set One", "Agents"), ("s2", "Set Two", "Main")], "source string, set_name string, category string").write.parquet(f"{d}/source_file.parquet")
    return d


@pytest.mark.parametrize("name", ["workload_extract", "workload_transform", "workload_load"])
def test_odd_records_against_sql(spark, odd, name):
    con = duckdb.connect()
    for t in ("card", "source_file"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{odd}/{t}.parquet/*.parquet')")
    query, sql = workload.QUERIES[name]
    cur = con.execute(sql)
    expected = pd.DataFrame(cur.fetchall(), columns=[c[0] for c in cur.description])
    assert len(expected) and canonical(query(spark, odd).toPandas()) == canonical(expected)


def test_a_record_is_built_once(spark, odd):
    """The conditions on its keys must not each build it again."""
    df = workload.workload_extract(spark, odd)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_concat") == 1 and df.count() == 32


def test_an_export_sorted_by_its_paths_numbers_no_runs(spark, tmp_path, monkeypatch):
    def never(*_):
        raise AssertionError("runs are numbered")

    monkeypatch.setattr(frame, "run_ids", never)
    s = Session(spark, base=str(tmp_path))
    s.create(spark.createDataFrame([(i, "ab c"[i % 4], f"{i % 3}") for i in range(60)], "i int, g string, h string"))
    s.query("MATCH {i, g, h} ORDER BY [g, h] SAVE JSONL {i} TO `of/${g}.jsonl`")
    for k, g in enumerate("ab c"):
        want = sorted(range(k, 60, 4), key=lambda i: (i % 3, i))
        assert [json.loads(x)["i"] for x in (tmp_path / "of" / f"{g}.jsonl").read_text().splitlines()] == want
    # of two variables, or sorted by another, a path may come back
    for order, path in (("[g, h]", "${h}"), ("[g, h]", "${g}${h}"), ("[h, g]", "${g}"), ("[g + h]", "${g}")):
        with pytest.raises(AssertionError, match="runs are numbered"):
            s.query(f"MATCH {{i, g, h}} ORDER BY {order} SAVE JSONL {{i}} TO `of/{path}.jsonl`")


KEYS = {"a": 1, "b-c": None, "": 3, " x": 4, "q'": 5, 'q"': 6, "a.b": 7, "?": 8, "é": 9, "n\nl": 10, "0": 11, "-": {"z": 1}, "'\"": 12, "[0]": [1]}


def test_any_key_of_an_object_is_found(spark):
    documents = [json.dumps(KEYS), "[1, 2]", '"s"', "null", "{}", None]
    rows = [(d, k) for d in documents for k in [*KEYS, "zz", "a\n", None]]
    got = spark.createDataFrame(rows, "d string, k string").select("d", "k", F.to_json(V.entry(V.Val(F.parse_json("d"), V.VARIANT), F.col("k"))).alias("x"))
    for r in got.collect():
        there = r["d"] == documents[0] and r["k"] in KEYS
        assert (json.loads(r["x"]) == KEYS[r["k"]] if there else r["x"] is None), r
    plain = got.where("k = 'a' and d like '{\"a\"%'")
    assert "$['" in plain._jdf.queryExecution().optimizedPlan().toString()


def test_keys_of_an_order_are_exact(spark):
    """What the JVM writes is what Python's JSON writes."""
    texts = ["", None, "a b~!", 'q"', "back\\", "é", "\x7f", "tab\t", "/", "a\n", "[", "]"]
    df = spark.createDataFrame([(t, n, b) for t in texts for n in (None, 0, -(2**62)) for b in (None, True)], "t string, n long, b boolean")
    t, n, b = (V.Val(F.col(c), df.schema[c].dataType) for c in "tnb")
    array = V.Val(F.to_variant_object(F.array(*[V.to_variant(x) for x in (t, n, b)])), V.VARIANT)
    for r in df.select("*", V.json_key(t).alias("one"), V.json_key(array, [t, n, b]).alias("all")).collect():
        assert r["one"] == json.dumps(r["t"]) and r["all"] == json.dumps([r["t"], r["n"], r["b"]])
