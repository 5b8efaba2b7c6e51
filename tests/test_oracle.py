"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from lumenflow.oracle import all_sql
from lumenflow.queries import all_queries
from lumenflow.sources.tables import TABLES
from scripts.check_oracle import digest

SF = os.environ.get("LUMENFLOW_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

# the package's own keys; those of the training-data subpackage have their tests there
QUERIES = all_queries()
SQL = all_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) == 50
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "new_tiering" in df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.cursor().execute(SQL[key])
    cols = [d[0] for d in res.description]
    expect = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(expect)
    assert digest(df.columns, rows)[0] == digest(cols, expect)[0]
