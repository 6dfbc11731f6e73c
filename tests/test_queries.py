"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from tessera.sources.readers import DRIVER_TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(SF):
        pytest.skip("driver tables not present")
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and df.columns == ["term", "value"]


def test_registry_consistent():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 80


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE:
        assert len(got.columns) > 0
        return
    want = con.execute(ORACLE[name]).fetchdf()
    c1, r1 = rows_of(got)
    c2, r2 = rows_of(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
