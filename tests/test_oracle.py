"""Every registered query against its SQL in DuckDB."""

import os

import duckdb
import pytest

from checks.catalog import all_queries
from checks.oracle import ORACLES

TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int"}

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("events", "conversations"):
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'"
        )
    return connection


def as_set(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(table, key=repr)


def test_every_query_has_sql():
    assert set(all_queries()) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_matches_sql(spark, duck, name):
    result = all_queries()[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [column[0] for column in expected.description]
    types = {column[0]: TYPES[str(column[1])] for column in expected.description}
    assert types == dict(result.dtypes)
    want = as_set(columns, expected.fetchall())
    got = as_set(result.columns, [tuple(row) for row in result.collect()])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


