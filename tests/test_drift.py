import json
from datetime import datetime, timedelta

from tessera.operators import drift

T0 = datetime(2020, 1, 1)


def _drops(spark, files):
    """files: (feed, name, day, records)"""
    rows = [(f, n, T0 + timedelta(days=d), i, r if isinstance(r, str | None) else json.dumps(r), "x", "y") for f, n, d, rs in files for i, r in enumerate(rs)]
    return spark.createDataFrame(rows, "feed string, file_name string, dropped_at timestamp, line_no int, payload string, entity string, path string")


def _changes(spark, files):
    out = drift.schema_changes(_drops(spark, files), "feed", "file_name", "dropped_at", "payload", "card")
    return sorted(tuple(r)[1:] for r in out.collect())


def rec(n, **kw):
    return {"card": n, **kw}


def test_added_removed_renamed_retyped(spark):
    a = [rec(i, mp="1", rarity=f"R{i}", old=i) for i in range(6)]
    b = [rec(i, mp=1, scarcity=f"R{i}" if i else "R9", new="n") for i in range(6)]
    got = _changes(spark, [("f", "b2", 40, b), ("f", "a1", 0, a)])
    assert got == [("b2", "added", "", "new"), ("b2", "removed", "old", ""), ("b2", "renamed", "rarity", "scarcity"), ("b2", "retyped", "mp", "mp")]


def test_files_are_ordered_by_time_across_months(spark):
    files = [("f", f"n{9 - k}", 20 * k, [rec(1, **{f"k{k}": "v"})]) for k in range(5)]
    got = _changes(spark, files)
    assert [(g[0], g[1], g[2] or g[3]) for g in got if g[1] == "added"] == []
    assert {g[0] for g in got} == {"n8", "n7", "n6", "n5"}  # the first file has no change


def test_nulls_absent_keys_and_repeats(spark):
    a = [rec(1, x=None), rec(1, x=None), rec(2, x="s")]
    b = [rec(1, x=None), rec(2)]
    c = [rec(1, x=3), None, "no json", "[1]"]
    got = _changes(spark, [("f", "a", 0, a), ("f", "b", 1, b), ("f", "c", 2, c)])
    assert got == []  # null only has no type to change from
    assert drift.schema_changes(_drops(spark, []), "feed", "file_name", "dropped_at", "payload", "card").collect() == []


def test_a_swap_with_other_values_is_no_renaming(spark):
    a = [rec(i, foil=bool(i % 2)) for i in range(8)]
    b = [rec(i, artist=f"A{i}") for i in range(8)]
    assert _changes(spark, [("f", "a", 0, a), ("f", "b", 1, b)]) == [("b", "added", "", "artist"), ("b", "removed", "foil", "")]


def test_feeds_are_apart(spark):
    got = _changes(spark, [("f", "a", 0, [rec(1, x="1")]), ("g", "b", 1, [rec(1, y="1")])])
    assert got == []


def test_unified_table(spark):
    files = [("f", "a", 0, [rec(i, rarity=f"R{i}") for i in range(5)]), ("f", "b", 1, [rec(i, rar={"value": f"R{i}", "checked": True}) for i in range(4)] + [rec(4, rar=["R4"])])]
    df = _drops(spark, files)
    names = {"rar": "rarity", "rarity": "rarity", "card": "card"}
    out = drift.unified(df, "payload", names, {"card": "bigint", "rarity": "string", "name": "int"}, ["file_name"])
    got = sorted(tuple(r) for r in out.collect())
    assert got[0] == ("a", 0, "R0", None, []) and got[-1] == ("b", 4, "R4", None, [])
    bad = drift.unified(_drops(spark, [("f", "a", 0, [rec("x")])]), "payload", {"card": "card"}, {"card": "bigint"}, ["file_name"])
    assert [r["failed"] for r in bad.collect()] == [["card"]]


def test_classes_of_names(spark):
    changes = spark.createDataFrame([("renamed", "a", "b"), ("renamed", "b", "c"), ("renamed", "x", "y"), ("added", "", "q")], "change string, old_field string, new_field string")
    assert drift.field_classes(changes, ["c", "z"]) == {"a": "c", "b": "c", "c": "c", "z": "z"}


def test_nested_paths(spark):
    a = [rec(i, meta={"a": i, "t": [{"u": 1}]}) for i in range(4)]
    b = [rec(i, meta={"b": i, "t": [{"u": "1"}]}) for i in range(4)]
    df = _drops(spark, [("f", "a", 0, a), ("f", "b", 1, b)])
    at = lambda depth: sorted(tuple(r)[2:] for r in drift.schema_changes(df, "feed", "file_name", "dropped_at", "payload", "card", depth).collect())
    assert at(1) == [] and at(2) == [("renamed", "meta.a", "meta.b")]
    assert at(4) == [("renamed", "meta.a", "meta.b"), ("retyped", "meta.t[].u", "meta.t[].u")]


def test_null_feeds_and_files(spark):
    got = _changes(spark, [(None, "a", 0, [rec(1, x="1")]), (None, None, 1, [rec(1, y="2")])])
    assert got == [(None, "added", "", "y"), (None, "removed", "x", "")]


def test_a_list_of_files_too_long_to_broadcast_changes_nothing(spark, monkeypatch):
    a = [rec(i, rarity=f"R{i}", old=i) for i in range(6)]
    b = [rec(i, scarcity=f"R{i}", **{"n'w": None}) for i in range(6)]
    files = [("f", "a", 0, a), ("f", "b", 1, b), ("g", "c", 0, b), ("g", "d", 2, a)]
    one = _changes(spark, files)
    assert ("b", "renamed", "rarity", "scarcity") in one and ("d", "renamed", "scarcity", "rarity") in one and ("b", "added", "", "n'w") in one
    monkeypatch.setattr(drift, "BROADCAST_FILES", 0)
    assert _changes(spark, files) == one


def test_what_the_consistent_table_cannot_hold_is_reported(spark):
    rs = [rec(1, rarity=["R", "U", "C"]), rec(2, rarity=[]), rec(3, rarity={"v": 1}), rec(4, rarity="R", **{"it's \"rare\".": "U"}), rec(5, **{"it's \"rare\".": "U"}), rec(6, rarity=None), rec(7, rarity="R", **{"it's \"rare\".": "R"})]
    names = {"card": "card", "rarity": "rarity", "it's \"rare\".": "rarity"}
    out = drift.unified(_drops(spark, [("f", "a", 0, rs)]), "payload", names, {"card": "int", "rarity": "string"}, ["file_name"])
    got = {r["card"]: (r["rarity"], r["failed"]) for r in out.collect()}
    assert got == {1: (None, ["rarity"]), 2: (None, ["rarity"]), 3: (None, ["rarity"]), 4: ("U", ["rarity"]), 5: ("U", []), 6: (None, []), 7: ("R", [])}
