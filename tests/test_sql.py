"""Every query that SQL can express, beside DuckDB."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_same_as_sql(spark, con, name):
    outcome, _ = compare(spark, con, name, SF_DIR)
    assert outcome.startswith("ok"), outcome


def test_every_sql_text_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
