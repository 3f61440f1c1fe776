import json
import pytest
from tessera.plans import frame
from tessera.session import Session


def test_files_are_read_in_the_order_of_their_paths(spark, tmp_path):
    """Spark packs splits into tasks by size: the larger file must not come first."""
    (tmp_path / "a.jsonl").write_text('{"n": "a1"}\n')
    (tmp_path / "b.jsonl").write_text("".join(json.dumps({"n": f"b{i}", "pad": "x" * 200}) + "\n" for i in range(500)))
    (tmp_path / "c.jsonl").write_text('{"n": "c1"}\n{"n": "c2"}\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        out = Session(spark, base=str(tmp_path)).query("LOAD JSONL FROM `${f}.jsonl` AS {n} WITH n[] AS all RETURN {all}").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert json.loads(str(out[0][0])) == ["a1", *[f"b{i}" for i in range(500)], "c1", "c2"]


@pytest.mark.parametrize("bucket", [1, 3, 8_192])
def test_buckets_of_the_order_change_no_run(spark, monkeypatch, bucket):
    monkeypatch.setattr(frame, "BUCKET", bucket)
    keys = "aabbbacccccab" * 5
    session = Session(spark)
    session.create(spark.createDataFrame([(i % 7, i, k) for i, k in enumerate(keys)], "g int, i int, k string"))
    runs = [tuple(r) for r in session.query("MATCH {g, i, k} ORDER BY g WITH k, i[] AS is RETURN {k, is}").collect()]
    rows = sorted(((str(i % 7), i, k) for i, k in enumerate(keys)))
    want = []
    for _, i, k in rows:
        if want and want[-1][0] == k:
            want[-1][1].append(i)
        else:
            want.append((k, [i]))
    assert [(k, list(x)) for k, x in runs] == want


@pytest.mark.parametrize("single", [True, False])
def test_save_constant_and_computed_paths(spark, tmp_path, single):
    session = Session(spark, base=str(tmp_path), single_files=single)
    session.create(spark.createDataFrame([(i, "ab c/ü%"[i % 3 :][:1], i) for i in range(300)], "i int, g string, x int"))
    session.query("MATCH {i, g} ORDER BY g SAVE JSONL {i} TO `out/${g}=.jsonl`")
    session.query('MATCH {i} SAVE JSONL {i} TO "all.jsonl"')

    def lines(p):
        parts = [p] if p.is_file() else sorted(p.glob("part-*"))
        return [json.loads(x)["i"] for q in parts for x in q.read_text().splitlines()]

    assert (tmp_path / "all.jsonl").is_file() == single and lines(tmp_path / "all.jsonl") == list(range(300))
    assert lines(tmp_path / "out" / "a=.jsonl") == list(range(0, 300, 3))
    assert sorted(x.name for x in tmp_path.iterdir()) == ["all.jsonl", "out"]
