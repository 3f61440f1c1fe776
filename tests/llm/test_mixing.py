import math

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing

SCHEMA = "doc_id long, source string, n_tokens long, weight double, key string, epochs int"


def _docs(spark, sizes):
    rows = [(i * 1000 + j, s, n, 1.0, "k", 7) for i, (s, ns) in enumerate(sizes.items()) for j, n in enumerate(ns)]
    return spark.createDataFrame(rows, SCHEMA)


def _targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeat int")


def _totals(mix):
    return {r["source"]: r["t"] for r in mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("t")).collect()}


def test_shares_and_caps(spark):
    docs = _docs(spark, {"a": [10] * 500, "b": [10] * 40, "c": [5] * 300, "unlisted": [9] * 50})
    targets = _targets(spark, [("a", 0.5, 1), ("b", 0.2, 3), ("c", 0.2, 1), ("none", 0.1, 5)])
    mix = mixing.mixed(docs, targets).cache()
    total = sum(_totals(mix).values())
    for s, share in (("a", 5 / 9), ("b", 2 / 9), ("c", 2 / 9)):
        assert abs(_totals(mix)[s] / total - share) < 0.01
    assert mix.groupBy("source").agg(F.max("copies").alias("m")).where("source = 'b' and m > 3 or source <> 'b' and m > 1").count() == 0
    report = {r["source"]: r for r in mixing.shares(mix, docs, targets).collect()}
    assert set(report) == {"a", "b", "c", "none"} and report["none"]["tokens"] == 0
    assert math.isclose(sum(r["actual_share"] for r in report.values()), 1)


def test_epochs_come_before_a_fraction(spark):
    docs = _docs(spark, {"a": [10] * 100, "b": [10] * 1000})
    mix = mixing.mixed(docs, _targets(spark, [("a", 0.5, 4), ("b", 0.5, 1)]), total=5000).where("source = 'a'")
    copies = {r["copies"]: r["n"] for r in mix.groupBy("copies").agg(F.count("*").alias("n")).collect()}
    assert copies == {2: 50, 3: 50}


def test_caps_cut_what_can_not_be_had(spark):
    docs = _docs(spark, {"a": [10] * 10, "b": [10] * 1000})
    targets = _targets(spark, [("a", 0.5, 2), ("b", 0.5, 1)])
    assert _totals(mixing.mixed(docs, targets, total=2000)) == {"a": 200, "b": 1000}
    report = {r["source"]: r for r in mixing.shares(mixing.mixed(docs, targets, total=2000), docs, targets, total=2000).collect()}
    assert report["a"]["most_copies"] == 2 and report["a"]["actual_share"] < 0.2


def test_a_scarce_source_does_not_size_the_mix(spark, monkeypatch):
    """p8_mix and p8_shares: the total follows the corpus, a scarce source stops at max_repeat and is reported."""
    from tessera.llm import queries

    docs = _docs(spark, {"a": [10] * 100, "b": [10] * 200, "scarce": [10], "unlisted": [9] * 50})
    targets = _targets(spark, [("a", 0.4, 2), ("b", 0.4, 2), ("scarce", 0.1, 5), ("none", 0.1, 3), ("zero", 0.0, 3)])
    monkeypatch.setattr(queries, "_sized", lambda *_: docs)
    monkeypatch.setattr(queries, "table", lambda *_: targets)
    got = _totals(queries.p8_mix(spark, ""))
    assert got == {"a": 1330, "b": 1330, "scarce": 50}  # 3010 tokens; 4/9 of it each, of which whole documents fit
    report = {r["source"]: r for r in queries.p8_shares(spark, "").collect()}
    assert {s: r["tokens"] for s, r in report.items()} == {**got, "none": 0, "zero": 0}
    assert {s: r["shortfall"] for s, r in report.items()} == {"a": 0, "b": 0, "scarce": 251, "none": 301, "zero": 0}
    assert {s: r["unused"] for s, r in report.items()} == {"a": 0, "b": 670, "scarce": 0, "none": 0, "zero": 0}
    assert mixing.corpus_total(docs.limit(0), targets) == mixing.corpus_total(docs, targets.limit(0)) == 0


@pytest.mark.parametrize(("most", "fine"), [(1, 2), (10, 7), (5_000, 4_096)])
def test_same_as_one_sorted_list(spark, monkeypatch, most, fine):
    """However small the buckets and the sorted parts are: what a greedy walk over all keys of a source gives."""
    docs = _docs(spark, {"a": [3 + i % 11 if i % 9 else 100 * (i % 5 + 1) for i in range(150)], "b": [50] * 100})
    docs = docs.withColumn("weight", F.lit(0.2) + (F.col("doc_id") % 7) / 5)
    targets = _targets(spark, [("a", 0.3, 2), ("b", 0.7, 1)])
    monkeypatch.setattr(mixing, "BUCKET_DOCS", most)
    monkeypatch.setattr(mixing, "FINE", fine)
    got = {(r["source"], r["doc_id"]): r["copies"] for r in mixing.mixed(docs, targets, 4_999).collect()}
    u = (F.pmod(F.xxhash64(F.lit(7), F.col("doc_id")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    want = {}
    for source, share in (("a", 0.3), ("b", 0.7)):
        keyed = sorted((r["k"], r["doc_id"], r["n_tokens"]) for r in docs.where(F.col("source") == source).select((-F.log(u) / F.col("weight")).alias("k"), "doc_id", "n_tokens").collect())
        available = sum(n for *_, n in keyed)
        epochs, left = divmod(math.floor(share * 4_999 + 1e-6), available)
        for _, d, n in keyed:
            want[source, d] = epochs + (n <= left)
            left -= n if n <= left else 0
    assert got == {k: c for k, c in want.items() if c}


def test_a_very_long_document_leaves_no_source_short(spark):
    docs = _docs(spark, {"a": [5] * 900 + [2500] * 3, "b": [10] * 100})
    mix = mixing.mixed(docs, _targets(spark, [("a", 0.5, 1), ("b", 0.5, 1)]))
    assert 990 <= _totals(mix)["a"] <= 1000


def test_heavier_documents_are_taken_more_often(spark):
    docs = _docs(spark, {"a": [10] * 2000, "b": [10] * 200}).withColumn("weight", F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.1))
    mix = mixing.mixed(docs, _targets(spark, [("a", 0.5, 1), ("b", 0.5, 1)])).where("source = 'a'")
    even = mix.where("doc_id % 2 = 0").count()
    assert even > 0.75 * mix.count()


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, "a", 5, None, "", 0), (1, "a", 5, None, "", 0), (2, None, 5, 1.0, "", 0), (3, "a", 0, 1.0, "", 0), (None, "a", None, 1.0, "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    targets = _targets(spark, [("a", 0.5, 2), ("a", 0.4, 3), (None, 0.1, 1), ("b", None, None)])
    assert _totals(mixing.mixed(docs, targets)) == {"a": 20}
    assert mixing.mixed(docs.limit(0), targets).collect() == []
    assert mixing.mixed(docs, targets.limit(0)).collect() == []
    assert [r["tokens"] for r in mixing.shares(mixing.mixed(docs.limit(0), targets), docs.limit(0), targets).collect()] == [0, 0]


@pytest.mark.parametrize(("text", "low", "high"), [(None, 0.05, 0.05), ("", 0.05, 0.05), ("word " * 100, 0.9, 1.0), ("1|2|" * 200, 0.05, 0.05), ("word " * 10, 0.05, 0.3)])
def test_quality(spark, text, low, high):
    (r,) = spark.createDataFrame([(text,)], "t string").select(mixing.quality(F.col("t")).alias("q")).collect()
    assert low <= r["q"] <= high
