"""Upserts, bulk updates and change feeds between two states of a keyed table.

Every operator takes states as DataFrames and returns the next state or the feed; nothing is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions.columns import moment
from lakekit.functions.money import money
from lakekit.operators.joins import new_keys
from lakekit.operators.ranking import latest_per_key
from lakekit.values import CHANGE_TYPES_TO_SHIP, DELETE, INSERT, UPDATE_AFTER, UPDATE_BEFORE

CHANGE_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")


def _once(keys: Sequence[str], value: Column) -> Column:
    """The value, in rows whose key occurs once; any other key stops the job."""
    message = F.concat(F.lit("duplicate key: "), F.to_json(F.struct(*keys)))
    return F.when(F.count(F.lit(1)).over(Window.partitionBy(*keys)) == 1, value).otherwise(F.raise_error(message))


def rows_by_key(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row per key with the other columns as a struct; the job fails if a key occurs twice.

    The check costs no shuffle or sort of its own: a join on the same keys that follows uses both again.
    """
    rest = [c for c in df.columns if c not in keys]
    payload = F.struct(*rest) if rest else F.struct(F.lit(True).alias("_present"))
    return df.select(*keys, _once(keys, payload).alias(name))


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails if a key occurs twice."""
    return df.withColumn("_unique", _once(keys, F.lit(True))).where("_unique").drop("_unique")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key and are added otherwise."""
    kept = new_keys(target, source, keys)
    return kept.unionByName(unique_rows(source, keys))


def insert_new_only(target: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The candidates whose key the target lacks: the rows to append."""
    return new_keys(candidates, target, keys)


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Rows that meet the condition get new values; all right-hand sides see the old row."""
    return df.withColumns(
        {c: F.when(condition, value).otherwise(F.col(c)) for c, value in changes.items()}
    )


def merge_accumulate(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    count: str,
    amount: str,
    mean: str,
) -> DataFrame:
    """Add a batch's counts and amounts to the groups of the target and derive the mean again.

    Amounts are added in cents. The mean is (old amount + new amount) / (old count + new count). Groups the target lacks are added; columns of
    the target that the batch does not know are NULL there and unchanged elsewhere. A NULL in a key is a group of its
    own, as in the aggregation that made the batch.
    """
    added = batch.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col(count).alias("_count"), F.col(amount).alias("_amount")
    )
    same_group = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
    both = target.join(added, same_group, "full")
    rows = F.when(F.col("_count").isNull(), F.col(count)).otherwise(
        F.coalesce(F.col(count), F.lit(0)) + F.col("_count")
    )
    summed = (F.coalesce(money(amount), F.lit(0)) + money("_amount")).cast("double")
    total = F.when(F.col("_amount").isNull(), F.col(amount)).otherwise(summed)
    averaged = F.when(F.col("_count").isNull(), F.col(mean)).otherwise(
        F.when(rows > 0, total / rows).otherwise(F.lit(0.0))
    )
    group = {k: F.when(F.col("_count").isNull(), F.col(k)).otherwise(F.col(f"_key_{k}")) for k in keys}
    new = {count: rows, amount: total, mean: averaged, **group}
    return both.select(*[new[c].alias(c) if c in new else F.col(c) for c in target.columns])


def not_yet_applied(batch: DataFrame, ledger: DataFrame, batch_id: str = "batch_id") -> DataFrame:
    """The rows of batches the ledger does not list: guards an accumulating merge against being run twice."""
    return batch.join(ledger.select(batch_id).distinct(), batch_id, "left_anti")


def latest_batch(df: DataFrame, watermark: str) -> DataFrame:
    """Rows whose watermark is the highest there is."""
    return df.where(F.col(watermark) == df.agg(F.max(watermark)).scalar())


def change_feed(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    version: int | Column,
    committed_at: datetime | Column,
) -> DataFrame:
    """What has to be done to turn one state into the other: one shuffle of each state by the keys."""
    columns = list(after.columns)
    old = rows_by_key(before.select(*columns), keys, "_old")
    new = rows_by_key(after, keys, "_new")
    changes = old.join(new, list(keys), "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    return as_feed(
        changes,
        keys,
        columns,
        version if isinstance(version, Column) else F.lit(version),
        committed_at if isinstance(committed_at, Column) else moment(committed_at),
    )


def as_feed(
    changes: DataFrame, keys: Sequence[str], columns: Sequence[str], version: Column, committed_at: Column
) -> DataFrame:
    """One or two feed rows per changed key, from its old and new row."""
    images = (
        F.when(F.col("_old").isNull(), F.array(_image(INSERT, "_new")))
        .when(F.col("_new").isNull(), F.array(_image(DELETE, "_old")))
        .otherwise(F.array(_image(UPDATE_BEFORE, "_old"), _image(UPDATE_AFTER, "_new")))
    )
    return changes.select(
        *keys,
        version.cast("bigint").alias("_commit_version"),
        committed_at.cast("timestamp_ntz").alias("_commit_timestamp"),
        F.explode(images).alias("_image"),
    ).select(
        *[F.col(c) if c in keys else F.col(f"_image.row.{c}").alias(c) for c in columns],
        F.col("_image.type").alias("_change_type"),
        "_commit_version",
        "_commit_timestamp",
    )


def _image(change_type: str, row: str) -> Column:
    return F.struct(F.lit(change_type).alias("type"), F.col(row).alias("row"))


def appended_feed(rows: DataFrame, version: int, committed_at: datetime) -> DataFrame:
    """Feed of an append-only step: its own rows, all inserts, no comparison of states."""
    return rows.select(
        "*",
        F.lit(INSERT).alias("_change_type"),
        F.lit(version).cast("bigint").alias("_commit_version"),
        moment(committed_at).alias("_commit_timestamp"),
    )


def changes_to_ship(feed: DataFrame) -> DataFrame:
    """Inserts and new images of updates."""
    return feed.where(F.col("_change_type").isin(*CHANGE_TYPES_TO_SHIP))


def merge_changes(target: DataFrame, feed: DataFrame, keys: Sequence[str], deletes: bool = False) -> DataFrame:
    """Apply a feed to a target: the last image of each key is upserted, deleted keys go if asked for."""
    wanted = (*CHANGE_TYPES_TO_SHIP, DELETE) if deletes else CHANGE_TYPES_TO_SHIP
    latest = latest_per_key(feed.where(F.col("_change_type").isin(*wanted)), keys, "_commit_version")
    kept = new_keys(target, latest, keys)
    written = latest.where(F.col("_change_type") != DELETE).select(*target.columns)
    return kept.unionByName(written)


def change_counts(feed: DataFrame) -> DataFrame:
    return feed.groupBy("_change_type").agg(F.count(F.lit(1)).alias("num_rows"))


def change_savings(current: DataFrame, feed: DataFrame) -> DataFrame:
    """Rows of the table, rows a receiver has to fetch, and rows it does not."""
    rows = current.agg(F.count(F.lit(1)).alias("total_rows"))
    shipped = changes_to_ship(feed).agg(F.count(F.lit(1))).scalar()
    return rows.withColumn("shipped_rows", shipped).withColumn(
        "saved_rows", F.col("total_rows") - F.col("shipped_rows")
    )
