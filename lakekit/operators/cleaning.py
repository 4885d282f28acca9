"""Cleaning and profiling of whole tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.functions.money import percent
from lakekit.operators.distinct import count_numbered


def _columns_of(df: DataFrame, *types: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def null_to_default(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def empty_to_null(df: DataFrame) -> DataFrame:
    """'' becomes NULL in every text column."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in _columns_of(df, T.StringType)})


def bool_to_int(df: DataFrame) -> DataFrame:
    """Every boolean column as 0/1."""
    return df.withColumns({c: F.col(c).cast("int") for c in _columns_of(df, T.BooleanType)})


def drop_all_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the columns that hold no value at all; one aggregation over the table finds them."""
    checked = [c for c in df.columns if c not in keep]
    if not checked:
        return df
    filled = df.agg(*[F.count(c).alias(c) for c in checked]).first()
    return df.drop(*[c for c in checked if filled[c] == 0])


def fill_missing_category(df: DataFrame, key: str) -> DataFrame:
    """NULL in text column C becomes 'NoC'; the key is left alone."""
    return df.fillna({c: f"No{c}" for c in _columns_of(df, T.StringType) if c != key})


def add_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def add_column_backfill(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column, or fill its gaps if it is there."""
    filled = F.coalesce(F.col(name), value) if name in df.columns else value
    return df.withColumn(name, filled)


def select_except(df: DataFrame, *dropped: str) -> DataFrame:
    return df.drop(*dropped)


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first in the given order, ties broken by every remaining column.

    The filter on row_number lets Spark keep one row per key in every task before the shuffle, so a key with very
    many rows does not meet in one task.
    """
    order = [*order_by, *[F.col(c).asc_nulls_last() for c in df.columns if c not in keys]]
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")


def validity_counts(df: DataFrame, flag: str) -> DataFrame:
    """Valid and invalid rows and the share of valid ones, in one pass."""
    rows, valid = F.count(F.lit(1)), F.count_if(F.col(flag))
    return df.agg(
        rows.alias("total_rows"),
        valid.alias("valid_rows"),
        (rows - valid).alias("invalid_rows"),
        F.floor(F.try_divide(valid * 100, rows)).cast("bigint").alias("valid_percent"),
    )


def value_counts(df: DataFrame, *columns: str, digits: int = 1) -> DataFrame:
    """Rows per combination of values and their share of all rows.

    The total is a scalar subquery over the same aggregation, which Spark runs once: no window over all groups.
    """
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("num_rows"))
    everything = counted.agg(F.sum("num_rows")).scalar()
    return counted.withColumn("percent_of_total", percent(F.col("num_rows"), everything, digits))


def distinct_profile(df: DataFrame, *columns: str, numbered: Collection[str] = ()) -> DataFrame:
    """All rows, and the distinct values of each column.

    Every column is counted by itself, so that rows aren't copied once per column: running numbers (`numbered`, and whole
    numbers) by bitmaps, other columns by their values.
    """

    def counted(c: str) -> Column:
        if c in numbered or isinstance(df.schema[c].dataType, T.IntegralType):
            return count_numbered(df, [], c, "n").scalar()
        # Spark would put several distinct counts of one table together again, over copies of its rows.
        return df.select(c).distinct().agg(F.count(c).alias("n")).scalar()

    every = {f"distinct_{c}": F.coalesce(counted(c), F.lit(0)) for c in columns}
    return df.agg(F.count(F.lit(1)).alias("total_rows")).withColumns(every)


def top_k(df: DataFrame, by: str, k: int, *tie_break: str) -> DataFrame:
    """The k rows with the highest value, NULL values last, ties in the order of the given columns.

    Spark plans sort + limit as a top-k per task followed by one merge of k rows from each.
    """
    return df.orderBy(F.desc_nulls_last(by), *[F.asc_nulls_last(c) for c in tie_break]).limit(k)


def random_sample(df: DataFrame, rows: int, key: str, seed: int = 0) -> DataFrame:
    """That many rows at random: those with the smallest hashes of seed and key, whatever the partitioning."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(drawn, key).limit(rows)
