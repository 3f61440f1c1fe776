import csv
import io
import random
import re

from tessera.operators.strict_load import CARD_LINE, LineFormat, rejects, strict_load

GOOD = '1,Set,"Na,me ""x""",Hazard,,1(2),10,,"two\nlines"'


def brute(raw):
    """A character-by-character reading of the format."""
    if raw is None:
        return "columns"
    cells, cell, i, state = [], "", 0, "start"
    while i <= len(raw):
        c = raw[i] if i < len(raw) else None
        if state == "start" and c == '"':
            state = "quoted"
        elif state in ("start", "plain"):
            if c is None or c == ",":
                cells.append(cell)
                cell, state = "", "start"
            elif c == '"':
                return "quoting"
            else:
                cell, state = cell + c, "plain"
        elif state == "quoted":
            if c is None:
                return "quoting"
            if c == '"' and i + 1 < len(raw) and raw[i + 1] == '"':
                cell, i = cell + '"', i + 1
            elif c == '"':
                state = "closed"
            else:
                cell += c
        elif state == "closed":
            if c not in (None, ","):
                return "quoting"
            cells.append(cell)
            cell, state = "", "start"
        i += 1
    if len(cells) != 9:
        return "columns"
    if not re.fullmatch(r"[1-9]\*?|-[1-9]|[0-9]?\([1-9]\)|", cells[5]):
        return "mp"
    if cells[6] not in ("", "-1", *map(str, range(1, 11))):
        return "mind"
    if any((ord(c) < 32 and c not in "\t\n") or 127 <= ord(c) < 160 or c == "�" for c in cells[8]):
        return "text"
    return None


def _lines():
    r = random.Random(5)
    out = [GOOD, None, "", ",", '"', '""', '"a"b', 'a"b', ' "a"', "1,2,3,4,5,6,7,8,9", ",,,,,,,,", ",,,,,,,,\r", ",,,,,,,,\t", ",,,,,,,,\x85", ",,,,,,,,�"]
    parts = ['"', ",", "a", "\n", "1*", "-1", "10", '""', "é", "(3)", "\x01"]
    out += ["".join(r.choice(parts) for _ in range(r.randint(1, 14))) for _ in range(300)]
    for _ in range(200):
        cells = [r.choice(["", "x", '"q"', '"a,b"', "1", "5*", "0(3)", "11", "-1", '"a""b"']) for _ in range(r.choice([8, 9, 9, 9, 10]))]
        out.append(",".join(cells))
    return out


def test_reasons_match_a_brute_reading(spark):
    lines = _lines()
    df = spark.createDataFrame(list(enumerate(lines)), "line_id long, raw string")
    got = {r["line_id"]: r["reason"] for r in rejects(df, "line_id", "raw").collect()}
    assert got == {i: b for i, x in enumerate(lines) if (b := brute(x))}


def test_loaded_lines_are_unquoted(spark):
    df = spark.createDataFrame([(1, GOOD), (2, "x")], "line_id long, raw string")
    (r,) = strict_load(df, "line_id", "raw").collect()
    expected = next(csv.reader(io.StringIO(GOOD)))
    assert [r[n] for n in CARD_LINE.fields] == expected


def test_repeated_ids_null_ids_and_extra_columns(spark, rows):
    df = spark.createDataFrame([(1, GOOD, "a"), (1, "bad", "b"), (1, "bad", "b"), (None, "bad", "c"), (None, GOOD, "c")], "line_id long, raw string, reason string")
    got = rows(rejects(df, "line_id", "raw"))
    assert got == [(1, "bad", "columns"), (1, "bad", "columns"), (None, "bad", "columns")]


def test_very_long_lines(spark):
    body = 'x""' * 200_000
    df = spark.createDataFrame([(1, f'1,2,3,4,5,,,8,"{body}"'), (2, f'1,2,3,4,5,,,8,"{body}'), (3, "," * 300_000)], "line_id long, raw string")
    assert {r["line_id"]: r["reason"] for r in rejects(df, "line_id", "raw").collect()} == {2: "quoting", 3: "columns"}


def test_empty_table_and_other_format(spark):
    df = spark.createDataFrame([], "line_id long, raw string")
    assert rejects(df, "line_id", "raw").collect() == []
    fmt = LineFormat(("a", "b"), (("b", r"\A[0-9]+\z"),))
    df = spark.createDataFrame([(1, "x,12"), (2, "x,y")], "line_id long, raw string")
    assert [r["offset_id"] for r in strict_load(df, "line_id", "raw", fmt).collect()] == [1]


def test_many_rejects_are_joined(spark, monkeypatch):
    from tessera.operators import strict_load

    df = spark.createDataFrame([(1, "a"), (None, "b"), (1, "a"), (2, None), (3, "1,s,n,t,,,,,x")], "rid long, raw string")
    one = sorted(map(repr, rejects(df, "rid", "raw").collect()))
    assert len(one) == 4
    monkeypatch.setattr(strict_load, "BROADCAST_REJECTS", 0)
    assert sorted(map(repr, rejects(df, "rid", "raw").collect())) == one
