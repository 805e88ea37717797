"""Every registered query that has SQL, against DuckDB, on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_sql import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["segment", "timestamp", "target", "target_0.025", "target_0.975"]


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    cursor = duck.sql(entry.oracle_sql()[name])
    assert compare(
        (df.columns, [tuple(r) for r in df.collect()]), (cursor.columns, cursor.fetchall())
    ) is None
