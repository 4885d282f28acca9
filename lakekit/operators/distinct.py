"""Exact distinct counts by bitmaps, for keys that are running numbers.

A value is split, without loss, into a bucket and a position in it: whole numbers by division, texts into all but their last
four digits and those digits. Each group and bucket has a bitmap of the positions seen. Tasks send bitmaps instead of values,
several counts need no copies of the rows, and bitmaps of batches can be stored and merged later, which counts cannot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Last digits of a text that make the position: a bitmap has 32,768 places.
DIGITS = 4


def bucket(df: DataFrame, name: str) -> Column:
    """The part of a value that names its bitmap; texts without four digits at the end have one to themselves."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.bitmap_bucket_number(value).cast("string")
    text = value.cast("string")
    return F.when(_numbered(text), F.concat(F.substr(text, F.lit(1), F.char_length(text) - DIGITS), F.lit(":4"))).otherwise(
        F.concat(text, F.lit(":0"))
    )


def position(df: DataFrame, name: str) -> Column:
    """The place of a value in its bitmap."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.bitmap_bit_position(value)
    text = value.cast("string")
    return F.when(_numbered(text), F.right(text, F.lit(DIGITS)).try_cast("long")).otherwise(F.lit(0).cast("long"))


def _numbered(text: Column) -> Column:
    tail = F.right(text, F.lit(DIGITS))
    return (F.char_length(tail) == DIGITS) & (F.translate(tail, "0123456789", "") == "")


def distinct_bits(df: DataFrame, keys: Sequence[str], name: str, *measures: Column) -> DataFrame:
    """(keys, _bucket, bits, measures): the values seen in each group. NULL values set no bit, but count for the measures.

    Rows of several of these tables are merged by `merge_bits`.
    """
    # NULL positions are skipped.
    seen = F.bitmap_construct_agg(F.when(F.col(name).isNotNull(), position(df, name)))
    return df.groupBy(*keys, bucket(df, name).alias("_bucket")).agg(seen.alias("bits"), *measures)


def merge_bits(bits: DataFrame, keys: Sequence[str]) -> DataFrame:
    return bits.groupBy(*keys, "_bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def number_of_bits() -> Column:
    """The distinct values of a group, over its merged bitmaps."""
    return F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint")


def count_numbered(df: DataFrame, keys: Sequence[str], name: str, alias: str) -> DataFrame:
    """Distinct values of a running number per group: one shuffle of bitmaps, then one of counts."""
    return distinct_bits(df.select(*keys, name), keys, name).groupBy(*keys).agg(number_of_bits().alias(alias))


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Bring a count to the groups of another aggregation of the same rows; keys may be NULL."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], name)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    return left.join(other, same).drop(*[f"_r_{k}" for k in keys])
