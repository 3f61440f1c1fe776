"""The registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in os.listdir(DIR):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DIR}/{f}')")
    return c


def canonical(df):
    def one(v):
        if isinstance(v, list) or hasattr(v, "tolist") and getattr(v, "ndim", 0):
            return [one(x) for x in v]
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        return round(float(v), 6) if isinstance(v, float) else v.item() if hasattr(v, "item") else v

    return sorted(repr([one(v) for v in r]) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


def test_flagship(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, con, name):
    got = entry.queries()[name](spark, DIR).toPandas()
    cur = con.execute(entry.oracle_sql()[name])
    expected = pd.DataFrame(cur.fetchall(), columns=[c[0] for c in cur.description])
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
