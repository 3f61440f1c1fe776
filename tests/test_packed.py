import pytest

from tessera.operators.packed import CANDIDATES, Names, clean, split_packed, split_value

NAMES = Names(["Salt & Ember", "Hook and Lantern", "Gate, the Lower", "Left/Right", "Brom Ford"])
ALL = tuple(d for d in CANDIDATES if d != " ")


@pytest.mark.parametrize(
    ("raw", "items"),
    [
        ("A, B", ["A", "B"]),
        ("A; B ;C", ["A", "B", "C"]),
        ("A / B | C", ["A", "B", "C"]),
        ("A, B and C", ["A", "B", "C"]),
        ("A, B, and C", ["A", "B", "C"]),
        (",A,, B,", ["A", "B"]),
        ('["A", "B C"]', ["A", "B C"]),
        ("'A'; 'B.'", ["A", "B."]),
        ('"A, B", C', ["A, B", "C"]),
        ("Salt & Ember & Left/Right, Gate, the Lower", ["Salt & Ember", "Left/Right", "Gate, the Lower"]),
        ("Hook　and Lаntern and X", ["Hook　and Lаntern", "X"]),
        ("Brom\nFord, X", ["Brom Ford", "X"]),
        ("Brom\nFord", ["Brom Ford"]),
        ("X\nY", ["X", "Y"]),
        ("X (old)", ["X (old)"]),
        ("it's, b", ["it's", "b"]),
        ("", []),
        (" , ;", []),
        ('"', []),
    ],
)
def test_split_value(raw, items):
    assert split_value(raw, ALL, NAMES) == items


def test_clean_keeps_inner_marks():
    assert clean(' "[a "b" c]" ') == 'a "b" c'
    assert clean("a\r\n b") == "a b"


def test_long_value_is_split_whole():
    raw = ", ".join(f"v{i}" for i in range(20_000))
    assert len(split_value(raw, ALL, NAMES)) == 20_000


def _table(spark, rows):
    return spark.createDataFrame(rows, "rid long, src string, skills string, item string, pos int, field string")


def test_delimiters_are_inferred_per_source(spark, rows):
    data = []
    for i in range(40):
        data.append((i, "a", "Red/Blue" if i % 2 else "Red", "x", 1, "y"))
        data.append((100 + i, "b", "Blue Red" if i % 2 else "Blue", "x", 1, "y"))
        data.append((200 + i, "c", "Red", "x", 1, "y"))
    data += [(300, None, None, "x", 1, "y"), (301, "a", "", "x", 1, "y"), (302, "a", "Red/Blue", "x", 1, "y"), (302, "a", "Red/Blue", "x", 1, "y")]
    df = _table(spark, data)
    out = split_packed(df, "rid", ["skills"], "src")
    assert out.columns == ["rid", "field", "pos", "item", "n_items"]
    got = rows(out)
    assert (1, "skills", 1, "Red", 2) in got and (1, "skills", 2, "Blue", 2) in got
    assert (101, "skills", 1, "Blue", 2) in got and (101, "skills", 2, "Red", 2) in got
    assert [r for r in got if r[0] == 302].__len__() == 4  # repeated rows stay
    assert not [r for r in got if r[0] in (300, 301)]


def test_a_blank_within_listed_names_is_no_delimiter(spark, rows):
    ref = spark.createDataFrame([("Old Town",), ("New Town",)], "name string")
    data = [(i, "s", ["Old Town", "New Town", "Old Town, New Town"][i % 3], "", 0, "") for i in range(60)]
    got = rows(split_packed(_table(spark, data), "rid", ["skills"], "src", {"skills": (ref, "name")}))
    assert {r[3] for r in got} == {"Old Town", "New Town"}


def test_many_names_in_shards(spark, rows, monkeypatch):
    from tessera.operators import packed

    ref = spark.createDataFrame([(f"Old {c}, New {c}",) for c in "abcdefgh"], "name string")
    data = [(i, "s", f"Old {'abcdefgh'[i % 8]}, New {'abcdefgh'[i % 8]}, Red", "", 0, "") for i in range(24)] + [(90 + i, "s", x, "", 0, "") for i, x in enumerate(["Red", "Red", "Blue", "Blue", "Red, Blue"])]
    names = {"skills": (ref, "name")}
    one = rows(split_packed(_table(spark, data), "rid", ["skills"], "src", names))
    monkeypatch.setattr(packed, "SHARD", 3)
    assert rows(split_packed(_table(spark, data), "rid", ["skills"], "src", names)) == one
    assert (0, "skills", 1, "Old a, New a", 2) in one
    monkeypatch.setattr(packed, "MAX_NAMES", 3)
    with pytest.raises(ValueError, match="listed names"):
        split_packed(_table(spark, data), "rid", ["skills"], "src", names)


@pytest.mark.parametrize("size", [1, 2, 3])
def test_shards_change_nothing(spark, rows, monkeypatch, size):
    """Guards, known pieces and whole names with a line break count from every shard."""
    from tessera.operators import packed

    ref = spark.createDataFrame([(f"Old {c}, New {c}",) for c in "abcdefgh"] + [("P, Q",), ("Q, R",), ("R, S",), ("Tall Oak",), ("Low Elm",), ("Zed\nYard",)], "name string")
    data = [(i, "s", f"Old {'abcdefgh'[i % 8]}, New {'abcdefgh'[i % 8]}, Red", "", 0, "") for i in range(24)]
    data += [(90 + i, "s", x, "", 0, "") for i, x in enumerate(["Red", "Red", "Blue", "Blue", "Red, Blue", "P, Q, R, S"])]
    data += [(200 + i, "t", x, "", 0, "") for i, x in enumerate(["Tall Oak\nLow Elm"] * 9 + ["Low\nElm", "Zed\nYard", "Low Elm"])]
    names = {"skills": (ref, "name")}
    one = rows(split_packed(_table(spark, data), "rid", ["skills"], "src", names))
    monkeypatch.setattr(packed, "SHARD", size)
    assert rows(split_packed(_table(spark, data), "rid", ["skills"], "src", names)) == one
    assert {(95, "skills", 1, "P, Q", 2), (95, "skills", 2, "R, S", 2), (0, "skills", 2, "Red", 2), (200, "skills", 2, "Low Elm", 2), (209, "skills", 1, "Low Elm", 1), (210, "skills", 1, "Zed Yard", 1)} <= set(one)


def test_rare_values_are_known_at_every_size(spark, rows):
    """Many equally frequent values, each of which stands alone twice, behind a delimiter that needs known pieces."""
    n = 2_500
    names = [f"{a}{b}{c}mar" for a in "bdfgklmnprstvz" for b in "aeiou" for c in "bdfgklmnprstvzbdfgklmnprstvzbdfgklmnprstvz"][: n // 2]
    names = list(dict.fromkeys(names))
    data = [(i, "s", names[i % len(names)], "", 0, "") for i in range(2 * len(names))]
    data += [(50_000 + i, "s", f"{names[i]} and {names[i + 1]}", "", 0, "") for i in range(0, 400, 2)]
    data += [(90_000, "s", "ab\ncd", "", 0, ""), (90_001, "s", "ab cd", "", 0, ""), (90_002, "s", "ab cd", "", 0, "")]
    got = rows(split_packed(_table(spark, data), "rid", ["skills"], "src").where("rid >= 50000"))
    assert len([r for r in got if 50_000 <= r[0] < 50_400 and r[4] == 2]) == 400
    assert (90_000, "skills", 1, "ab cd", 1) in got


def test_types_tell_delimiters_of_open_values(spark, rows):
    """No piece stands alone anywhere: integers, codes, dates and names are split by their types, prose and dates aren't."""
    data = [(i, "n", f"{i};{i + 1};{i + 2}", "", 0, "") for i in range(300)]
    data += [(1_000 + i, "u", f"user{i}; user{i + 1}; user{i + 2}", "", 0, "") for i in range(300)]
    data += [(2_000 + i, "d", f"01/0{i % 9 + 1}/20{i % 90 + 10}|02/03/2021", "", 0, "") for i in range(60)]
    data += [(3_000 + i, "w", f"Xa{'bcdefghij'[i % 9]}lo, Yo{'klmnopqrs'[i % 9]}ran", "", 0, "") for i in range(60)]
    data += [(4_000 + i, "p", f"He went home, and then, after some {i} hours of talk about it, slept. So did they.", "", 0, "") for i in range(60)]
    data += [(5_000 + i, "q", f"{i} {i + 5} {i + 9}", "", 0, "") for i in range(60)]
    data += [(6_000 + i, "r", f"Lower Ka{'bcdefghij'[i % 9]}lo", "", 0, "") for i in range(60)]
    n = {}
    for r in rows(split_packed(_table(spark, data), "rid", ["skills"], "src")):
        n.setdefault(r[0] // 1_000, set()).add(r[4])
    assert n == {0: {3}, 1: {3}, 2: {2}, 3: {2}, 4: {1}, 5: {3}, 6: {1}}


@pytest.mark.parametrize("bound", ["BROADCAST_SOURCES", "BROADCAST_LINES"])
def test_bounds_of_broadcasts_change_nothing(spark, rows, monkeypatch, bound):
    from tessera.operators import packed

    data = [(i, "ab"[i % 2], ["Red/Blue", "Red Blue", "Red", "Blue", "Tall Oak", "Tall\nOak", "Red\nBlue"][i % 7], "", 0, "") for i in range(140)]
    one = rows(split_packed(_table(spark, data), "rid", ["skills"], "src"))
    assert (5, "skills", 1, "Tall Oak", 1) in one
    monkeypatch.setattr(packed, bound, 0)
    assert rows(split_packed(_table(spark, data), "rid", ["skills"], "src")) == one


def test_empty_table(spark):
    assert split_packed(_table(spark, []), "rid", ["skills", "item"], "src").collect() == []


def test_no_source_column(spark, rows):
    df = spark.createDataFrame([(i, "a;b") for i in range(5)] + [(9, "a"), (10, "b"), (11, "a"), (12, "b")], "rid long, v string")
    got = rows(split_packed(df, "rid", ["v"]))
    assert (0, "v", 2, "b", 2) in got and (9, "v", 1, "a", 1) in got
