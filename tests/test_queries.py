"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    # queries of the optional subpackage have tests of their own
    assert set(E.BASE) <= set(E.queries()) and set(E.BASE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.BASE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert digest(df.columns, got) == digest(cols, want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive"]
    assert df.count() > 0
