"""Every query with SQL gives the same rows as DuckDB."""

import duckdb
import pytest
from check import TABLES, compare

import __spark_entry__ as contract

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, sf, con):
    result = compare(contract.queries()[name](spark, sf), con.sql(ORACLES[name]))
    assert result.startswith("ok") and "TYPES" not in result, result
