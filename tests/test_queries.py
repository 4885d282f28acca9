"""Every registered query against its SQL, and the shape of every plan."""

from __future__ import annotations

import __spark_entry__ as driver
import oracle
import pytest
from conftest import executed_plan

from lakekit import registry

QUERIES = registry.queries()
SQL = registry.oracle_sql()
# Operators whose result SQL cannot state: random draws, file sizes, iterative models.
WITHOUT_SQL = {"binary_files", "file_health", "cluster_search", "project_2d", "publish_clusters"}


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, db, folder, name):
    df = QUERIES[name](spark, folder)
    columns, rows = oracle.spark_rows(df)
    wanted_columns, wanted = oracle.duckdb_rows(db, SQL[name])
    assert columns == wanted_columns
    assert rows == wanted
    plan = executed_plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_runs_without_sql(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
