"""Every registered query of the subpackage that SQL can express, against its SQL."""

import os

import duckdb
import pytest

from rosterlake.llm.queries import ORACLE, QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, name, sf):
    folder, connection = f"/root/testdata/{sf}", duckdb.connect()
    for file in os.listdir(folder):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{file}'")
    result = connection.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    frame = QUERIES[name](spark, folder)
    assert sorted(frame.columns) == sorted(columns)
    found = sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr)
    assert found == sorted(result.fetchall(), key=repr)
