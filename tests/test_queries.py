"""Every registered query against its DuckDB oracle on the smallest fixture (the driver's gate uses sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import TABLES, digest  # noqa: E402

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"country_iso3", "month_start", "grs_0_100", "coverage_flag"} <= set(df.columns)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    res = con.execute(SQL[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows) == digest(ocols, orows)
