"""Joins that need more than a call to DataFrame.join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest estimated size of a side that is sent to every executor when asked to.
BROADCAST_LIMIT = 64 * 1024 * 1024
# Bytes of a row in the hash table of a broadcast, apart from its values.
ROW_BYTES = 64
# Facts for which the periods of a validity join may be repeated once more, and the most buckets of a period.
FACTS_PER_COPY = 8
MOST_BUCKETS = 4096


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a DataFrame, from file sizes; nothing is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def counted_bytes(df: DataFrame) -> int:
    """Size of the rows in the hash table of a broadcast, counted by running the query.

    The estimate from file sizes does not bound it: keys that were numbered in order take ten times their files and more.
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns))) + ROW_BYTES
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only if the estimated size is within the limit; otherwise the join shuffles."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def join_master(facts: DataFrame, master: DataFrame, fact_key: str, master_key: str) -> DataFrame:
    """Left join to a master table: rows without a master row stay."""
    return facts.join(master, F.col(fact_key) == F.col(master_key), "left")


def join_facts(master: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a master table to its many facts: every master row stays.

    Written as an inner join plus the master rows without facts. A left join could neither split the facts of a
    key that holds very many of them nor broadcast a small master; the inner join can do both.
    """
    matched = master.join(facts, list(keys))
    unmatched = master.join(facts.select(*keys).distinct(), list(keys), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def new_keys(candidates: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidate rows whose key the target does not have.

    If only the candidates are small, the target is first cut down to their keys: its key columns are scanned, but
    not shuffled. Candidates that are small by estimate are counted before their keys go through the driver.
    """
    existing = target.select(*keys)
    wanted = candidates.select(*keys)
    if estimated_bytes(existing) > BROADCAST_LIMIT >= estimated_bytes(wanted) and counted_bytes(wanted) <= BROADCAST_LIMIT:
        existing = existing.join(F.broadcast(wanted), list(keys), "left_semi")
    return candidates.join(existing, list(keys), "left_anti")


def _number(df: DataFrame, name: str) -> Column:
    """A moment as a whole number: days of dates, microseconds of timestamps, other numbers rounded down."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    return F.floor(column).cast("long")


def _bucket(number: Column, origin: int, width: int) -> Column:
    return F.floor((number - F.lit(origin)) / F.lit(width)).cast("int")


def bucket_width(
    facts: DataFrame, periods: DataFrame, at: str, valid_from: str, valid_to: str
) -> tuple[int, int, int, int]:
    """(origin, last moment, width, bytes of the periods by bucket) of time buckets for a validity join.

    As narrow as two limits allow: all periods together are repeated once for every FACTS_PER_COPY facts at most, and a
    single one MOST_BUCKETS times. From two small aggregations, over the facts' moments and the periods' ends.
    """
    moments = facts.agg(F.min(_number(facts, at)), F.max(_number(facts, at)), F.count(at)).first()
    first, last, rows = moments[0] or 0, moments[1] or 0, moments[2]
    start = F.greatest(_number(periods, valid_from), F.lit(first))
    end = F.least(F.coalesce(_number(periods, valid_to), F.lit(last)), F.lit(last))
    length = F.when(end >= start, (end - start).cast("double"))
    size = F.octet_length(F.to_json(F.struct(*periods.columns)))
    count, covered, size = periods.agg(*[F.coalesce(x, F.lit(0)) for x in (F.count(length), F.sum(length), F.sum(size))]).first()
    copies = count + rows // FACTS_PER_COPY
    width = max(1, -(-(last - first + 1) // MOST_BUCKETS), int(covered / max(1, copies)) + 1)
    # A period touches two buckets more than its length fills at most.
    return first, last, width, int(size / max(1, count) * (2 * count + covered / width))


def join_validity(
    facts: DataFrame, periods: DataFrame, key: str, at: str, valid_from: str, valid_to: str
) -> DataFrame:
    """Equi-join on the key, kept where the moment lies in [valid_from, valid_to); an open end is NULL.

    Joined by key and time bucket: a period stands in every bucket that it touches, a fact in one, and the exact condition
    decides. A fact so meets few of a key's many periods, and the facts of a key that holds much of the table are dealt out by
    their buckets. The width of the buckets follows from the rows; periods that stay small by bytes are broadcast.
    """
    first, last, width, size = bucket_width(facts, periods, at, valid_from, valid_to)
    start = _bucket(F.greatest(_number(periods, valid_from), F.lit(first)), first, width)
    end = _bucket(F.least(F.coalesce(_number(periods, valid_to), F.lit(last)), F.lit(last)), first, width)
    in_buckets = (
        periods.withColumnRenamed(key, "_period_key")
        .withColumns({"_start": start, "_end": end})
        .where(F.col("_start") <= F.col("_end"))
        .withColumn("_period_bucket", F.explode(F.sequence("_start", "_end")))
        .drop("_start", "_end")
    )
    if size <= BROADCAST_LIMIT:
        in_buckets = F.broadcast(in_buckets)
    inside = (F.col(at) >= F.col(valid_from)) & (F.col(valid_to).isNull() | (F.col(at) < F.col(valid_to)))
    dealt = facts.withColumn("_bucket", _bucket(_number(facts, at), first, width)).alias("f")
    same = (F.col(f"f.{key}") == F.col("_period_key")) & (F.col("_bucket") == F.col("_period_bucket"))
    return dealt.join(in_buckets, same & inside).drop("_period_key", "_bucket", "_period_bucket")


def join_lookup(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]
) -> DataFrame:
    """Left join to a lookup table on equal keys, bringing in the named columns only."""
    picked = lookup.select(*keys, *[c.alias(name) for name, c in columns.items()])
    return facts.join(picked, list(keys), "left")
