"""Distributed rankings against plain windows over a small table, with a key that holds a third of all rows."""

from __future__ import annotations

import pytest
from conftest import executed_plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakekit.functions.money import percent
from lakekit.operators.cleaning import dedup_by_key, top_k, value_counts
from lakekit.operators.ranking import global_ntile, global_position, latest_per_key, pareto_top_n


@pytest.fixture
def skewed(spark):
    """900 items; a third of them in one category, many equal amounts."""
    return spark.range(900).select(
        F.col("id").alias("item"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("cat"),
        (F.pmod(F.hash("id"), F.lit(40)) + 1).cast("decimal(28,2)").alias("amount"),
    )


@pytest.mark.parametrize("size, tiles", [(0, 5), (3, 5), (5, 5), (101, 5), (1000, 7)])
def test_tiles_equal_ntile(spark, size, tiles):
    df = spark.range(size).select("id", (F.col("id") % 4).alias("v")).repartition(6)
    order = [F.desc("v"), F.asc("id")]
    wanted = df.withColumn("tile", F.ntile(tiles).over(Window.orderBy(*order)))
    assert rows(global_ntile(df, tiles, order, "tile").select("id", "v", "tile")) == rows(wanted)


def test_positions_are_a_permutation(spark):
    df = spark.range(500).repartition(9)
    placed = global_position(df, [F.desc("id")], "p")
    assert rows(placed.select("p", "id")) == [(i, 499 - i) for i in sorted(range(500), key=lambda i: repr((i, 499 - i)))]


@pytest.mark.parametrize("parts", [1, 16, 1024])
def test_pareto_equals_whole_windows(skewed, parts):
    whole = Window.partitionBy("cat")
    ordered = whole.orderBy(F.desc("amount"), "item").rowsBetween(Window.unboundedPreceding, 0)
    wanted = (
        skewed.withColumns(
            {
                "rank_categoria": F.rank().over(whole.orderBy(F.desc("amount"))),
                "pct_categoria": percent(F.col("amount"), F.sum("amount").over(whole)),
                "pct_acumulado_pareto": percent(F.sum("amount").over(ordered), F.sum("amount").over(whole)),
            }
        )
        .where("rank_categoria <= 5")
    )
    assert rows(pareto_top_n(skewed, "cat", "amount", "item", 5, parts)) == rows(wanted)


def test_dedup_is_deterministic_and_limits_before_the_shuffle(skewed):
    once = dedup_by_key(skewed, ["cat"])
    assert rows(once) == rows(dedup_by_key(skewed.repartition(5, "item"), ["cat"]))
    plan = executed_plan(once)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.rindex("Exchange hashpartitioning")


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "a"), (2, 5, None)], "k int, v int, x string")
    assert rows(latest_per_key(df, ["k"], "v")) == [(1, 2, "a"), (2, 5, None)]


def test_shares_add_up(skewed):
    counted = value_counts(skewed, "cat", digits=4).collect()
    assert sum(r.num_rows for r in counted) == 900
    assert abs(sum(r.percent_of_total for r in counted) - 100) < 0.01


def test_total_reuses_the_aggregation(skewed):
    df = value_counts(skewed, "cat")
    df.collect()
    assert "ReusedExchange" in executed_plan(df)


def test_top_k_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, 9)], "k int, v int")
    best = top_k(df, "v", 3, "k")
    assert [r.k for r in best.collect()] == [4, 2, 3]
    assert "TakeOrderedAndProject" in executed_plan(best)
