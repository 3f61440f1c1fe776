
import json

import pytest

from tessera.functions.values import QueryError
from tessera.plans import ast as A
from tessera.plans.lexer import QuerySyntaxError
from tessera.plans.parser import parse, parse_expression, parse_pattern
from tessera.repl import main, split_statements
from tessera.session import Session

DOCS = [
    {"set": "A", "name": "x", "mp": None, "text": ["l1", "l2"], "type": "Character"},
    {"set": "A", "name": "y", "class": "Agent", "text": ["l3"], "type": "Hazard", "n": 1},
    {"set": "B", "name": "é", "mp": "2", "text": [], "type": "Hazard", "n": 1.0, "o": {"a": 1, "b": {"c": 2}}},
]


@pytest.fixture
def base(tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.jsonl").write_text("\n".join(map(json.dumps, DOCS[:2])) + "\n", encoding="utf-8")
    (tmp_path / "j/b.jsonl").write_text(json.dumps(DOCS[2]) + "\n", encoding="utf-8")
    (tmp_path / "one.json").write_text(json.dumps({"x": {"k": {"v": 1}}, "y": [1, 2]}, indent=1))
    (tmp_path / "p.txt").write_text("\na.*\nb\n")
    return tmp_path


@pytest.fixture
def store(spark, base):
    s = Session(spark, base=str(base))
    s.query("LOAD JSONL FROM `j/${source}.jsonl` AS card CREATE card;")
    return s


def plain(v):
    if hasattr(v, "toPython"):
        return v.toPython()
    if hasattr(v, "asDict"):
        return {k: plain(x) for k, x in v.asDict().items()}
    return [plain(x) for x in v] if isinstance(v, list) else v


def run(s, q):
    df = s.query(q)
    return sorted(([plain(v) for v in r] for r in df.collect()), key=repr), df.columns


def values(s, q):
    return run(s, q)[0]


# -- syntax


def test_precedence():
    e = parse_expression("NOT a == b AND c OR d + e != f")
    assert e.op == "and" and isinstance(e.left, A.Binary) and isinstance(e.left.left, A.Not)  # NOT binds tighter than ==
    assert e.right.op == "or" and e.right.right.op == "!="  # OR binds tighter than AND
    for bad in ("a == b c", "a == b + c"):  # the right side of a comparison is no sum
        with pytest.raises(QuerySyntaxError):
            parse_expression(bad)


def test_keywords_are_names_where_names_are_due():
    q = parse("match {set, name, match} where set == match return {set, match}").statements[0]
    assert len(q.reads) == 2 and isinstance(q.write, A.Return)
    assert parse('WITH card AS {set, type = "", order: x[]} RETURN set').statements


def test_comments_and_missing_semicolon():
    s = parse("-- a remark; more\nMATCH x /* ; */;; MATCH y")
    assert len(s.statements) == 2


def test_patterns_parse():
    p = parse_pattern('{a, b: "x" AS b, c = null, d: [e, f], g: h[], i: `p${q}r`, ...rest}')
    assert [x.key for x in p.pairs] == list("abcdgi") and p.rest == A.PVar(("rest",))
    assert parse_pattern("{[k]: v}") == A.PUnpack(A.PVar(("k",)), A.PVar(("v",)))
    assert parse_pattern("[]") == A.PConst([])
    assert parse_expression("-5") == A.Const(-5) and parse_expression("a + 5").right == A.Const(5)


@pytest.mark.parametrize("bad", ["MATCH", "MATCH {a", "RETURN", 'LOAD XML FROM "x" AS y', "MATCH {a: } RETURN a", "SET 1 = 2", "WITH a + b RETURN a", 'RETURN "x', "MATCH a ! b", "MERGE {a: 1} {b}"])
def test_wrong_scripts(bad):
    with pytest.raises(QuerySyntaxError):
        parse(bad)


# -- reading


def test_load_json_jsonl_text(spark, base):
    s = Session(spark, base=str(base))
    assert values(s, 'LOAD JSON FROM "one.json" AS {x: {[key]: {v}}, y: n[]}') == [["k", 1, 1], ["k", 2, 1]]
    assert values(s, 'LOAD TEXT FROM "p.txt" AS line') == [[""], ["a.*"], ["b"]]  # empty lines stay
    got, cols = run(s, "LOAD JSONL FROM `j/${file}.jsonl` AS {name}")
    assert cols == ["file", "name"] and got == [["a", "x"], ["a", "y"], ["b", "é"]]
    assert values(s, 'WITH "b" AS file LOAD JSONL FROM `j/${file}.jsonl` AS {name} RETURN name') == [["é"]]
    with pytest.raises(QueryError):
        s.query('LOAD TEXT FROM "none.txt" AS x')


def test_missing_is_not_null(store):  # Q1
    assert values(store, "MATCH {name, mp}") == [["2", "é"], [None, "x"]]
    assert values(store, "MATCH {name, mp: null}") == [["x"]]
    assert values(store, 'MATCH {name, mp = "d"}') == [["2", "é"], ["d", "y"], [None, "x"]]


def test_rest_alias_nested(store):
    assert values(store, "MATCH {o: {a, b: {c}} AS o, ...rest} RETURN {a, c, o, keys: rest.includes(\"o\")}") == [[1, 2, {"a": 1, "b": {"c": 2}}, False]]
    assert values(store, 'MATCH {name: n.a, set: n.b, mp: "2"} RETURN n') == [[{"a": "é", "b": "B"}]]


def test_constants(store):
    assert values(store, "MATCH {n: 1, name}") == [["y"], ["é"]]  # 1 == 1.0
    assert values(store, "MATCH {text: [], name}") == [["é"]]


def test_tuple_ignores_extra_elements(store):  # Q9
    assert values(store, "MATCH {text: [first], name}") == [["l1", "x"], ["l3", "y"]]
    assert values(store, "MATCH {text: [a, b]}") == [["l1", "l2"]]
    with pytest.raises(QueryError):
        store.query("MATCH {text: [a, ...b]}").collect()


def test_unwind_of_what_is_no_array_gives_nothing(store):
    assert values(store, "MATCH {name: c[]}") == []
    assert values(store, "MATCH {text: t[], name}") == [["x", "l1"], ["x", "l2"], ["y", "l3"]]


def test_repeated_variable_is_a_filter(spark):
    s = Session(spark)
    assert values(s, "WITH [[1, 1], [1, 2]] AS [a, a][]") == [[1]]
    assert values(s, 'WITH "a" AS v, "b" AS w SET v = w RETURN v') == [["b"]]
    assert values(s, 'WITH "a" AS v, "b" AS v') == []


def test_template_is_anchored_at_the_start_only(spark):  # Q8
    s = Session(spark)
    assert values(s, 'WITH "abcabX" AS `a${x}b`') == [["bca"]]
    assert values(s, 'WITH "xab" AS `a${x}b`') == []
    assert values(s, 'WITH "a\\nb" AS `a${x}`') == [[""]]


def test_no_records(spark):  # Q23
    s = Session(spark)
    assert values(s, "MATCH {a, b: c[]}") == []


def test_context_columns_are_sorted(store):  # Q24
    assert run(store, "MATCH {set, name, mp}")[1] == ["mp", "name", "set"]
    assert run(store, "MATCH {set, name} RETURN {set, name}")[1] == ["set", "name"]


# -- expressions


@pytest.mark.parametrize(
    ("e", "v"),
    [
        ("1 + 2", 3),
        ("1 + 0.5", 1.5),
        ('"a" + "b"', "ab"),
        ('[1] + [2, 3]', [1, 2, 3]),
        ("null == null", True),
        ("1 == 1.0", True),
        ('"1" == 1', False),
        ("[1, 2] == [1, 2]", True),
        ("{a: 1} == {a: 1}", True),
        ("{a: 1, b: 2} != {b: 2, a: 1}", False),
        ("NOT null", True),
        ('NOT ""', True),
        ("NOT [0]", False),
        ("NOT {}", True),
        ('"" AND 1', ""),
        ('"x" AND 1', 1),
        ('"" OR "b"', "b"),
        ('"a-b-c".replace("-", "+")', "a+b+c"),
        ('"a-b-c".replace("-", "+", 1)', "a+b-c"),
        ('"ab".replace("", ".")', ".a.b."),
        ('"a.b.".split(".")', ["a", "b", ""]),
        ('"abc".split("")', ["a", "b", "c"]),
        ('"".split("")', []),
        ('"".split(",")', [""]),
        ('"a,b".split()', ["a,b"]),
        ('"a b c".split(" ", 1)', ["a", "b c"]),
        ('["a", "b"].join()', "a,b"),
        ('"abc".join("-")', "a-b-c"),
        ('[].join("-")', ""),
        ('"abc".includes("bc")', True),
        ('[1, "a", null].includes(null)', True),
        ('[1, "a"].includes("a")', True),
        ('{a: 1}.includes("a")', True),
        ('"  a b\\n".trim()', "a b"),
        ('"xay".match("(a)|(b)")', ["a", "a", None]),
        ('"x".match("y")', None),
        ('"abc"[0]', "a"),
        ('"abc"[-1]', "c"),
        ('[1, 2, 3][-2]', 2),
        ('{a: {b: 2}}.a.b', 2),
        ('{a: 1, b: "x"}["b"]', "x"),
        ("{...{a: 1, b: 2}, b: 3}", {"a": 1, "b": 3}),
        ('[0, ...[1, 2], "x"]', [0, 1, 2, "x"]),
        ('`a${"b" + "c"}d${"e"}`', "abcde"),
        ('CASE WHEN 1 == 2 THEN "a" WHEN "t" THEN "b" END', "b"),
        ('CASE WHEN null THEN "a" END', None),
        ('CASE WHEN null THEN "a" ELSE "z" END', "z"),  # Q14
        ('CASE 2 WHEN 1 THEN "a" WHEN 2 THEN "b" ELSE "c" END', "b"),
        ('"\\u00e9"', "é"),
        ("[null]", [None]),
        ("-1 + -2", -3),
        ('EXISTS(WITH [1, 2] AS x[] WHERE x == 2)', True),
        ('ARRAY(WITH [1, 2] AS x[] RETURN x + 1)', [2, 3]),
        ('{a: 1} IS JSON({type: "object", required: ["a"]})', True),
        ('{a: 1} IS NOT JSON({type: "array"})', True),
    ],
)
def test_expressions(spark, e, v):
    (got,), _ = run(Session(spark), f"RETURN {{value: {e}, other: 0}}")
    assert got[0] == v and type(got[0]) is type(v)


def test_errors_are_met_or_null(spark, store):  # Q22
    with pytest.raises(Exception, match="no key"):
        store.query("MATCH card RETURN card.mp").collect()
    soft = Session(spark, base=store.engine.base, strict=False)
    soft.query("LOAD JSONL FROM `j/${f}.jsonl` AS c CREATE c")
    assert values(soft, "MATCH card RETURN card.class") == [["Agent"], [None], [None]]
    with pytest.raises(QueryError):
        store.query("RETURN unknown")
    with pytest.raises(QueryError):
        store.query('RETURN "a".upper()')
    with pytest.raises(QueryError):
        store.query('RETURN 1 + "a"')


# -- joins, subqueries


def test_natural_join_and_partial_objects(store):
    assert len(values(store, "MATCH {set, name} MATCH {set, name: other}")) == 5
    s = store
    assert values(s, 'WITH {a: 1} AS o MATCH {o, name} RETURN {name, c: o.b.c}') == [["é", 2]]  # agree on shared keys


def test_exists(store):
    assert values(store, 'MATCH {name, set} WHERE EXISTS(MATCH {set, class: "Agent"}) RETURN name') == [["x"], ["y"]]
    assert values(store, 'MATCH {name, set} WHERE NOT EXISTS(MATCH {set, class: c} WHERE c == "Agent" AND name == "x") RETURN name') == [["y"], ["é"]]
    assert values(store, "MATCH {name, text} RETURN {name, some: EXISTS(WITH text AS t[] MATCH {name, text: t[]})}") == [["x", True], ["y", True], ["é", False]]


def test_array_subquery_keeps_order(store):
    assert values(store, "MATCH {name, set} RETURN {name, mates: ARRAY(MATCH {set, name: n} RETURN n)}") == [["x", ["x", "y"]], ["y", ["x", "y"]], ["é", ["é"]]]
    assert values(store, "MATCH {name, text} RETURN {name, up: ARRAY(WITH text AS t[] WHERE t != \"l1\" RETURN t + \"!\")}") == [["x", ["l2!"]], ["y", ["l3!"]], ["é", []]]


def test_file_join_with_patterns(spark, base):
    s = Session(spark, base=str(base))
    q = 'WITH ["abc", "c"] AS v[] SET ps = ARRAY(LOAD TEXT FROM "p.txt" AS p RETURN "^" + p + "$") WHERE NOT EXISTS(WITH v, ps AS p[] WHERE v.match(p)) RETURN v'
    assert values(s, q) == [["c"]]


# -- order, sets, groups


def test_order_by_json_text(spark):  # Q4
    s = Session(spark)
    got = [plain(r[0]) for r in s.query('WITH ["b", "é", "10", "9", "Z", "a"] AS x[] ORDER BY x RETURN x').collect()]
    assert got == ["10", "9", "Z", "é", "a", "b"]
    got = [plain(r[0]) for r in s.query("WITH [9, 10, 1] AS x[] ORDER BY x RETURN x").collect()]
    assert got == [1, 10, 9]


def test_distinct_keeps_the_first(spark):
    s = Session(spark)
    df = s.query('WITH [["b", 1], ["a", 2], ["b", 1]] AS [k, n][] ORDER BY k RETURN DISTINCT {k, n}')
    assert [[plain(v) for v in r] for r in df.collect()] == [["a", 2], ["b", 1]]
    assert values(s, "WITH [1, 1, 2] AS x[] RETURN DISTINCT x") == [[1], [2]]


def test_groups_are_runs(spark):  # Q2
    s = Session(spark)
    assert values(s, 'WITH [["a", 1], ["a", 2], ["b", 3], ["a", null]] AS [k, v][] WITH k, v[] AS vs') == [["a", [1, 2]], ["a", [None]], ["b", [3]]]
    assert values(s, "WITH [1, 2] AS x[] WITH {all: x[]} AS o RETURN o.all") == [[[1, 2]]]


def test_runs_over_bucket_ends(spark, monkeypatch):
    from tessera.plans import frame

    monkeypatch.setattr(frame, "BUCKET", 3)
    s = Session(spark)
    s.create(spark.createDataFrame([("a" if i < 8 or i > 10 else "b", i) for i in range(20)], "k string, i int").coalesce(1))
    assert values(s, "MATCH {k, i} WITH k, i[] AS xs") == [["a", list(range(8))], ["a", list(range(11, 20))], ["b", [8, 9, 10]]]


def test_runs_in_the_order_of_a_text(spark, monkeypatch):
    from tessera.plans import frame

    monkeypatch.setattr(frame, "RANGES", 4)
    s = Session(spark)
    s.create(spark.createDataFrame([("a" if i // 7 % 2 else "b", f"{i:03}") for i in range(60)], "k string, t string"))
    got = values(s, "MATCH {k, t} ORDER BY t WITH k, t[] AS ts")
    assert sorted(len(ts) for _, ts in got) == [4, *[7] * 8] and sorted(x for _, ts in got for x in ts) == [f"{i:03}" for i in range(60)]


def test_union_and_nulls_for_absent_columns(store):
    got, cols = run(store, 'MATCH {name: "x" AS name} RETURN {name} UNION MATCH {set: "B" AS set} RETURN {set} UNION MATCH {name: "y" AS name} RETURN {name}')
    assert cols == ["name", "set"] and got == [["x", None], ["y", None], [None, "B"]]


# -- writes


def test_create_returns_nothing_and_appends_anything(spark):  # Q12
    s = Session(spark)
    assert s.query("CREATE {a: 1}; CREATE [1, 2]") is None
    assert values(s, "MATCH x[]") == [[1], [2]]
    assert values(s, "MATCH {a}") == [[1]]


def test_merge_is_deep_and_never_inserts(store):  # Q6
    store.query('MERGE {o: {b: {d: 3}}, mp: ["x"]} INTO {name: "é"}; MERGE {z: 1} INTO {name: "none"}')
    ((mp, name, o),) = values(store, "MATCH {mp, name: \"é\" AS name, o}")
    assert o == {"a": 1, "b": {"c": 2, "d": 3}} and mp == ["x"]
    assert values(store, "MATCH {z}") == []


def test_last_patch_wins(spark):
    s = Session(spark)
    s.query('CREATE {k: 1, v: ""}')
    s.query('WITH ["a", "b", "c"] AS v[], 1 AS k MERGE {v} INTO {k}')
    assert values(s, "MATCH {v}") == [["c"]]
    s.query("WITH [{v: \"d\"}, {w: \"e\"}] AS p[], 1 AS k MERGE {...p} INTO {k}")
    assert values(s, "MATCH {k, ...r} RETURN r") == [[{"v": "d", "w": "e"}]]


def test_merge_reads_what_was_there_before(spark):  # Q10
    s = Session(spark)
    s.query("CREATE {n: 1, next: 2}; CREATE {n: 2, next: 1}")
    s.query("MATCH {n, next} MERGE {n: next} INTO {n}")
    assert values(s, "MATCH {n, next}") == [[1, 1], [2, 2]]
    s.query("MATCH x CREATE x")
    assert len(values(s, "MATCH {n}")) == 4


def test_grouped_merge_and_defaults(store):  # Q15, Q16
    store.query('MATCH {set, name, text: line[]} SET line = line.replace("l", "L") MERGE {text: line[]} INTO {set, name, none = null}')
    assert values(store, "MATCH {name, text}") == [["x", ["L1", "L2"]], ["y", ["L3"]], ["é", []]]


def test_delete(store):
    store.query('WITH "A" AS set DELETE {set, class: "Agent"}')
    assert values(store, "MATCH {name}") == [["x"], ["é"]]
    store.query("DELETE {mp: null}")
    assert values(store, "MATCH {name}") == [["é"]]
    store.query("DELETE _")
    assert values(store, "MATCH x RETURN x") == []


def test_many_writes_cut_the_lineage(spark):
    s = Session(spark)
    s.create(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    for i in range(10):
        s.query(f'MERGE {{v: "{i}"}} INTO {{k: 1}}')
    assert values(s, "MATCH {k, v}") == [[1, "9"], [2, "b"]]


def test_set(store):
    assert values(store, 'MATCH {name: "é" AS name, o} SET o = {b: {e: 1}} SET o.f = 2 RETURN o') == [[{"a": 1, "b": {"c": 2, "e": 1}, "f": 2}]]
    assert values(store, "MATCH {name} SET @last = name; RETURN @last") == [["é"]]


def test_indexes_change_nothing(store):  # Q18
    before = values(store, 'MATCH {name, mp = "d"}')
    store.query("CREATE INDEX i ON {name, mp}")
    assert values(store, 'MATCH {name, mp = "d"}') == before
    with pytest.raises(QueryError):
        store.query("CREATE INDEX i ON {name}")
    store.query("DROP INDEX i")
    with pytest.raises(QueryError):
        store.query("DROP INDEX i")


def test_save(store, base):
    store.query('MATCH card SAVE JSONL card TO "out/all.jsonl"')
    assert [json.loads(x)["name"] for x in (base / "out/all.jsonl").read_text(encoding="utf-8").splitlines()] == ["x", "y", "é"]
    store.query("MATCH {set, name} SAVE TEXT name TO `r/${set}.txt`")
    assert (base / "r/A.txt").read_text() == "x\ny\n" and (base / "r/B.txt").read_text(encoding="utf-8") == "é\n"
    store.query('WITH [["a", "1"], ["b", "2"], ["a", "3"]] AS [k, v][] SAVE TEXT v TO `q/${k}.txt`')  # Q13
    assert (base / "q/a.txt").read_text() == "3\n" and (base / "q/b.txt").read_text() == "2\n"
    store.query('MATCH {name: "none"} SAVE TEXT "x" TO "never.txt"')
    assert not (base / "never.txt").exists()
    with pytest.raises(QueryError):
        store.query('MATCH card SAVE JSON card TO "x.json"')


def test_save_as_directory(spark, base):
    s = Session(spark, base=str(base), single_files=False)
    s.query('WITH [3, 1, 2] AS x[] SAVE JSONL x TO "dir.jsonl"')
    assert (base / "dir.jsonl").is_dir()
    assert values(s, 'LOAD JSONL FROM "dir.jsonl" AS x') == [[1], [2], [3]]


def test_prompt(spark, base):
    assert split_statements('a ";" b; c')[0] == ['a ";" b'] and split_statements("a; b")[1] == " b"
    out = []
    main(spark, lines=["WITH [1, 2] AS x[]\n", "RETURN {x};\n", "BAD;\n"], write=out.append)
    assert out[:2] == ['{"x":1}', '{"x":2}'] and out[2].startswith("QuerySyntaxError")


def test_pushdown_and_pruning(spark, tmp_path):
    spark.createDataFrame([(1, "a", 2.0)], "k int, s string, v double").write.parquet(str(tmp_path / "t.parquet"))
    df = Session(spark).query(f'LOAD PARQUET FROM "{tmp_path}/t.parquet" AS {{s: "a", k}}')
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [EqualNullSafe(s,a)]" in plan and "ReadSchema: struct<k:int,s:string>" in plan
