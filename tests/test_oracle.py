"""Every registered query against DuckDB at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, table
from medledger.catalogue import QUERIES
from tests.conftest import SF_DIR

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_claims_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_duckdb(name, spark, duck):
    df = entry.queries()[name](spark, SF_DIR)
    cur = duck.execute(ORACLE[name])
    assert table(df.columns, df.collect()) == table([d[0] for d in cur.description], cur.fetchall())


def test_entry_returns_the_monthly_view(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["year_month", "fiscal_year", "claim_count"]
    assert df.count() > 0
