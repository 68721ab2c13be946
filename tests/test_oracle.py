"""Every registered query with an oracle matches DuckDB on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, con, name):
    sdf = QUERIES[name](spark, sf)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["credit_category", "income_category", "n_applications", "approval_rate"]
    assert df.count() > 0
