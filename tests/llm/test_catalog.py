"""Registered queries of the text operators against their SQL."""

from __future__ import annotations

import oracle
import pytest

from lakekit.llm import catalog


@pytest.mark.parametrize("name", ["op10_fast_sketching", "line_rules_base"])
def test_same_rows_as_sql(spark, db, folder, name):
    assert oracle.spark_rows(catalog.QUERIES[name](spark, folder)) == oracle.duckdb_rows(db, catalog.ORACLES[name])


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14))
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
