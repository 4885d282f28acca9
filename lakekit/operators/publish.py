"""Publishing result tables under business names, in full, in part or masked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.columns import mask_prefix, moment
from lakekit.operators.history import read_history, snapshot_history


def alias_path(share: str, alias: str) -> str:
    """Folder of the published table 'domain.name'."""
    domain, _, name = alias.partition(".")
    if not domain or not name:
        raise ValueError(f"an alias is 'domain.name', not {alias!r}")
    return f"{share}/{domain}/{name}"


def publish_dataset(tables: Mapping[str, DataFrame], share: str) -> None:
    """Export copies of tables under their aliases."""
    for alias, df in tables.items():
        df.write.mode("overwrite").parquet(alias_path(share, alias))


def row_subset(df: DataFrame, column: str, value: object) -> DataFrame:
    """Only the rows of one partition value; the filter reaches the scan."""
    return df.where(F.col(column) == F.lit(value))


def masked(df: DataFrame, mask: Sequence[str], allow: Sequence[str]) -> DataFrame:
    """Masked columns first, then the allowed ones; every other column stays at home."""
    return df.select(
        *[c for c in allow if c not in mask][:1],
        *[mask_prefix(c).alias(f"{c}_masked") for c in mask],
        *[c for c in allow if c not in mask][1:],
    )


def publish_with_history(spark: SparkSession, path: str, feed: DataFrame, share: str, alias: str) -> None:
    """Export all versions of a history table, its commits and a change feed."""
    target = alias_path(share, alias)
    read_history(spark, path).write.partitionBy("_version").mode("overwrite").parquet(f"{target}/states")
    snapshot_history(spark, path).write.mode("overwrite").parquet(f"{target}/commits")
    feed.write.mode("overwrite").partitionBy("_commit_version").parquet(f"{target}/changes")


def consume_published(spark: SparkSession, share: str, alias: str) -> DataFrame:
    return spark.read.parquet(alias_path(share, alias))


def access_audit(
    log: DataFrame, event_type: str, as_of: datetime, days: int, fields: Mapping[str, str | Column]
) -> DataFrame:
    """Access events of one kind in the last days: nested fields flattened, newest first."""
    since = moment(as_of) - F.make_dt_interval(F.lit(days))
    recent = log.where((F.col("event_type") == event_type) & (F.col("event_time") >= since))
    return recent.select(
        "event_time", *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in fields.items()]
    ).orderBy(F.desc("event_time"))
