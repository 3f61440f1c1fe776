import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import canonical
from tessera.llm.canonical import Entry, Shard, Tree, _entries, allowed, distance, nearest, with_keys

NAMES = ["Velmarrin", "Dûnreth", "Great Wyrm", "River Sprite", "Halvéni", "Lowland Man", "Haven", "Free Hold", "Free Holt Inn"]
ENTRIES = [(f"K{i}", n) for i, n in enumerate(NAMES)]


def reference(a, b):
    """The same metric, recursively by its definition over prefixes."""
    from functools import lru_cache

    @lru_cache(None)
    def d(i, j):
        if i == 0 or j == 0:
            return i + j
        best = min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        for k in range(i - 1, 0, -1):
            for m in range(j - 1, 0, -1):
                if a[k - 1] == b[j - 1] and a[i - 1] == b[m - 1]:
                    best = min(best, d(k - 1, m - 1) + (i - k - 1) + 1 + (j - m - 1))
        return best

    return d(len(a), len(b))


def test_distance_is_the_metric():
    r = random.Random(3)
    words = ["".join(r.choice("abc") for _ in range(r.randint(0, 6))) for _ in range(40)]
    for a in words:
        for b in words[:15]:
            assert distance(a, b) == reference(a, b) == distance(b, a)
            for c in words[:6]:
                assert distance(a, c) <= distance(a, b) + distance(b, c)
    assert distance("ca", "abc") == 2  # a swap with an insertion in between: the metric form


def test_tree_finds_all_that_a_scan_finds():
    r = random.Random(4)
    words = sorted({"".join(r.choice("abcd") for _ in range(r.randint(1, 8))) for _ in range(300)})
    t = Tree(words)
    for q in words[::17] + ["zzz", "", "abcdabcd"]:
        for k in (0, 1, 2, 3):
            assert sorted(t.within(q, k)) == sorted((d, w) for w in words if (d := distance(q, w)) <= k)
    assert Tree([]).within("a", 2) == []


@pytest.mark.parametrize(
    ("value", "key"),
    [
        ("VELMARRIN", "K0"), ("Velmarirn", "K0"), ("the Velmarrin", "K0"), ("Velmarrins", "K0"), ("Velmarrin (old)", "K0"), ("Velmarrin race", "K0"), ("Velmarrin?", "K0"),
        ("dunreth", "K1"), ("Dnreth", "K1"), ("GreatWyrm", "K2"), ("Great-Wyrm", "K2"), ("Wyrm, Great", "K2"), ("Wyrm Great", "K2"), ("Great yWrm", "K2"),
        ("RIVE SPRITE", "K3"), (" Halveni ", "K4"), ("Lowlans Ma", "K5"), ("a haven", "K6"), ("Hven", "K6"), ("Freehold", "K7"), ("FH", "K7"), ("GW", "K2"),
        ("unknown", None), ("", None), ("?", None), ("X", None), ("Velm", None), ("n/a", None),
    ],
)
def test_best(value, key):
    entries = [Entry(k, n, "".join(w[0] for w in n.split()).casefold() if " " in n and not n.startswith("Free Holt") else None) for k, n in ENTRIES]
    found = Shard(entries).best(value, frozenset(["the"]), frozenset(["(old", "race"]))
    assert (found and found[2]) == key


def test_ties_go_to_the_nearest_as_written_then_the_lowest_key():
    assert Shard([Entry("B", "abcdef"), Entry("A", "abcdeg")]).best("abcdex")[2] == "A"
    for entries in ([Entry("k1", "Ost"), Entry("k2", "Öst")], [Entry("k2", "Öst"), Entry("k1", "Ost")]):
        s = Shard(entries)
        assert [s.best(v)[2] for v in ("Öst!", "Öst", "Ost", "OST", "ost.")] == ["k2", "k2", "k1", "k1", "k1"]


@pytest.mark.parametrize("size", [1, 2, 3, 20_000])
@pytest.mark.parametrize("bound", [0, 200_000])
def test_shards_change_nothing(spark, monkeypatch, size, bound):
    """Initials, forms and ties are decided over all entries."""
    ref = spark.createDataFrame([("a", "Red Lion"), ("b", "Rose Lane"), ("c", "Öst"), ("d", "Ost"), ("e", "Blue Boar"), ("f", "Tall Oak")], "k string, n string")
    asked = _values(spark, ["RL", "BB", "Öst!", "OST", "Blu Boar", "near Tall Oak", "near Blue Boar", "near Rose Lan", "near Nothing", "by Tall Oak"])
    monkeypatch.setattr(canonical, "SHARD_ENTRIES", size)
    monkeypatch.setattr(canonical, "ROUND", 2)
    got = {r.value: r.ref_key for r in nearest(asked, ref, "k", ["n"], True, broadcast_entries=bound).collect()}
    assert got == {"RL": "", "BB": "e", "Öst!": "c", "OST": "d", "Blu Boar": "e", "near Tall Oak": "f", "near Blue Boar": "e", "near Rose Lan": "b", "near Nothing": "", "by Tall Oak": "f"}
    assert {r.short for r in _entries(ref, "k", ["n"], True).collect()} == {None, "bb", "to"}


def test_thresholds():
    assert [allowed(n) for n in (1, 3, 4, 6, 12)] == [0, 0, 1, 2, 3]


def _values(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_broadcast_and_sharded_agree(spark, monkeypatch):
    r = random.Random(9)
    names = sorted({"".join(r.choice("abcdefgh") for _ in range(r.randint(6, 10))) for _ in range(300)})
    ref = spark.createDataFrame([(f"K{i:04}", n, "x") for i, n in enumerate(names)], "k string, n string, value string")
    asked = _values(spark, [n[:-1] + "x" for n in names[:60]] + ["zzzzzzzz", "", "?"])
    a = {tuple(x) for x in nearest(asked, ref, "k", ["n"]).collect()}
    monkeypatch.setattr(canonical, "SHARD_ENTRIES", 70)
    monkeypatch.setattr(canonical, "ROUND", 3)
    b = {tuple(x) for x in nearest(asked, ref, "k", ["n"], broadcast_entries=10).collect()}
    assert a == b and ("zzzzzzzz", "") in a and len(a) == 63
    brute = {v.value: min(((distance(v.value, n), k) for k, n in zip([f"K{i:04}" for i in range(len(names))], names) if distance(v.value, n) <= 2), default=(0, ""))[1] for v in asked.collect()}
    assert {v: k for v, k in a} == brute


def test_rows_get_their_keys(spark, rows):
    ref = spark.createDataFrame(ENTRIES, "k string, n string")
    data = spark.createDataFrame([(1, "GreatWyrm", "a"), (2, "GreatWyrm", "b"), (3, "nothing", "c"), (4, "x" * 300_000, "d")], "id int, v string, ref string")
    answers = nearest(data.select(F.col("v").alias("value")).distinct(), ref, "k", ["n"]).withColumnRenamed("value", "v")
    assert rows(with_keys(data, ["v"], answers).select("id", "ref", "ref_key")) == [(1, "a", "K2"), (2, "b", "K2"), (3, "c", ""), (4, "d", "")]
    assert nearest(_values(spark, []), ref, "k", ["n"]).collect() == []
    assert [r.ref_key for r in nearest(_values(spark, ["a"]), ref.limit(0), "k", ["n"]).collect()] == [""]
