"""Queries over the given tables, one per operator, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakekit.registry import changesets, cleansing, controls, ingestion, models, reports, storage, texts
from lakekit.registry.sql import with_views

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (ingestion, cleansing, reports, changesets, storage, controls, texts, models)


def queries() -> dict[str, Query]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for module in MODULES for name, sql in module.ORACLES.items()}
