from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import executed_plan, rows
from pyspark.sql import functions as F

from lakekit.operators import joins


@pytest.fixture(autouse=True)
def no_broadcast_by_spark_itself(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, -1)
    yield
    for name in names:
        spark.conf.unset(name)


def brute(facts, periods):
    return sorted(
        (
            (*f, a, b, p)
            for f in facts
            for k, a, b, p in periods
            if f[0] is not None and f[0] == k and f[1] is not None and a is not None and a <= f[1] and (b is None or f[1] < b)
        ),
        key=repr,
    )


def joined(spark, facts, periods, kind):
    left = spark.createDataFrame(facts, f"k string, at {kind}, n int")
    right = spark.createDataFrame(periods, f"k string, a {kind}, b {kind}, p int")
    return joins.join_validity(left, right, "k", "at", "a", "b").select("f.k", "at", "n", "a", "b", "p")


@pytest.mark.parametrize("kind", ["long", "date", "timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("limit", [0, joins.BROADCAST_LIMIT])
def test_same_rows_as_every_pair(spark, monkeypatch, kind, limit):
    monkeypatch.setattr(joins, "BROADCAST_LIMIT", limit)
    rng = random.Random(limit)
    moment = {
        "long": lambda i: i - 40,
        "date": lambda i: date(1969, 12, 1) + timedelta(days=i),
        "timestamp_ntz": lambda i: datetime(1969, 12, 31) + timedelta(minutes=17 * i),
        "timestamp": lambda i: datetime(2024, 3, 1) + timedelta(seconds=i),
    }[kind]
    facts = [(rng.choice(["hot", "hot", "b", "c", None]), moment(rng.randrange(120)), i) for i in range(300)] + [("b", None, -1)]
    periods = []
    for i in range(60):
        a = rng.randrange(-20, 140)
        b = rng.choice([None, a, a - 3, a + 1, a + rng.randrange(90)])
        periods.append((rng.choice(["hot", "b", "c", "d"]), moment(a), None if b is None else moment(b), i))
    periods += [(None, moment(0), None, 100), ("b", None, moment(9), 101), periods[0]]
    result = joined(spark, facts, periods, kind)
    assert rows(result) == brute(facts, periods)
    assert ("BroadcastHashJoin" in executed_plan(result)) == (limit > 0)


def test_without_facts_or_periods(spark):
    assert joined(spark, [], [("a", 1, 2, 3)], "long").count() == 0
    assert joined(spark, [("a", 1, 2)], [], "long").count() == 0
    assert joined(spark, [("a", None, 2)], [("a", 1, 2, 3)], "long").count() == 0


def test_facts_of_a_hot_key_are_dealt_out(spark, monkeypatch):
    """Two periods of one product: its facts stand in many buckets, and the periods are repeated only as often as that pays."""
    facts = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("at"))
    periods = spark.createDataFrame([("hot", 0, 500, 1), ("hot", 500, None, 2)], "k string, a long, b long, p int")
    first, last, width, size = joins.bucket_width(facts, periods, "at", "a", "b")
    assert (first, last) == (0, 19_999) and (last - first) // width > 1000
    monkeypatch.setattr(joins, "BROADCAST_LIMIT", 0)
    result = joins.join_validity(facts, periods, "k", "at", "a", "b")
    assert result.count() == 20_000
    plan = executed_plan(result)
    assert "SortMergeJoin" in plan and "_bucket" in plan


def test_repeated_periods_follow_the_rows(spark):
    """Ten thousand long periods and few facts: each period stands in a few buckets only."""
    facts = spark.createDataFrame([("x", 0), ("x", 10**9)], "k string, at long")
    periods = spark.range(10_000).select(F.col("id").cast("string").alias("k"), F.lit(0).cast("long").alias("a"), F.lit(None).cast("long").alias("b"))
    first, last, width, _ = joins.bucket_width(facts, periods, "at", "a", "b")
    assert (last - first) // width <= 2
