"""The registered queries against their SQL in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__
from faultsift.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_all_thirteen_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = QUERIES[name](spark, SF_DIR)
    want = duck.execute(f"SELECT {', '.join(result.columns)} FROM ({SQL[name]})").fetchall()
    got = [tuple(row) for row in result.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(got) > 0
    assert {len(row) for row in got} == {len(result.columns)}
