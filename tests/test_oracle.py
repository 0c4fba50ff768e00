"""Every named query against its oracle on the smallest test tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
import check_oracle

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in check_oracle.TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def oracle():
    return entry.oracle_sql()


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_oracle(spark, con, oracle, name):
    result = check_oracle.compare(spark, con, name, FOLDER, oracle)
    assert result.startswith(("ok", "rows")), result


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0
