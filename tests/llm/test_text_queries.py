"""The registered queries of the subpackage on the smallest tables."""

import os

import pytest

from tessera.llm import queries

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")

COLUMNS = {
    "p3_found": [("rec_id", "bigint"), ("field", "string"), ("clean", "string")],
    "p4_found": [("rec_id", "bigint"), ("field", "string"), ("pos", "int"), ("ref_key", "string")],
    "p5_found": [("rec_id", "bigint"), ("field", "string"), ("restored_md5", "string")],
    "p7_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    "p9_found": [("doc_id", "bigint"), ("band", "int")],
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_runs(spark, name):
    df = queries.queries()[name](spark, DIR)
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_tasks_without_rows(spark, tmp_path, name):
    """Tables of many parts, most of them empty, and a scan of more tasks than rows."""
    for f in os.listdir(DIR):
        table = spark.read.parquet(f"{DIR}/{f}")
        (table.limit(30) if f.startswith(("card.", "documents", "level")) else table).coalesce(1).write.parquet(str(tmp_path / f))
        table.limit(0).write.mode("append").parquet(str(tmp_path / f))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        queries.queries()[name](spark, str(tmp_path)).count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_garbled_names_are_no_look_alike_cases(spark):
    found = queries.p3_found(spark, DIR).select("rec_id", "field")
    garbled = queries.p5_found(spark, DIR).select("rec_id", "field")
    assert found.join(garbled, ["rec_id", "field"]).count() == 0


def test_listed_values_are_no_cases(spark):
    card = spark.read.parquet(f"{DIR}/card.parquet")
    races = spark.read.parquet(f"{DIR}/race_ref.parquet").select("race")
    exact = card.join(races, "race").select("rec_id")
    assert queries.p4_found(spark, DIR).where("field = 'race'").join(exact, "rec_id").count() == 0
