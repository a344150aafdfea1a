"""Every registered query against its SQL, on the smallest of the given data sets."""

import os

import pytest

import __spark_entry__ as entry_point
from tidemark.plans.queries import QUERIES
from tests.oracle import connect, duckdb_result, spark_result

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sql, name):
    columns, rows = spark_result(entry_point.queries()[name](spark, FOLDER))
    expected_columns, expected_rows = duckdb_result(sql, entry_point.oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected_rows)
    assert rows == expected_rows
    assert rows


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_point.oracle_sql())


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
