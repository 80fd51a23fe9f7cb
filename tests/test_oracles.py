"""Every query against its SQL over the smallest driver tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query(spark, con, name):
    got = entry_points.queries()[name](spark, FOLDER).toArrow()
    assert compare(got, con.sql(entry_points.oracle_sql()[name]).to_arrow_table()) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
