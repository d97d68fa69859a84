"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload.oracle import ORACLE
from workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(
            f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'"
        )
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert ORACLE.keys() <= entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, tables, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    result = tables.execute(entry_points.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = result.fetchall()
    found = [tuple(row[c] for c in columns) for row in frame.collect()]
    assert in_order(found) == in_order(expected)


@pytest.mark.parametrize("name", ["q2_specialty_mix", "q3_zip_footprint", "q4_top_zips"])
def test_order_of_ordered_queries(spark, tables, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    expected = tables.execute(entry_points.oracle_sql()[name]).fetchall()
    assert [tuple(row) for row in frame.collect()] == expected


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["practice_zip", "provider_count"]
    assert 0 < frame.count() <= 10
