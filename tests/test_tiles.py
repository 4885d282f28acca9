from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import executed_plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakekit.operators import ranking
from lakekit.plans import trends


def wanted(df, tiles):
    def by(*order):
        return F.ntile(tiles).over(Window.orderBy(*order, F.asc("k")))

    return df.withColumns({"a": by(F.asc("x")), "b": by(F.desc("y"))})


def found(df, tiles):
    return ranking.tiles_by_histogram(df, tiles, {"a": F.col("x"), "b": -F.col("y")}, "k")


@pytest.mark.parametrize("size, tiles", [(0, 5), (3, 5), (5, 5), (101, 5), (1000, 7), (997, 4)])
@pytest.mark.parametrize("shape", ["spread", "tied", "constant"])
def test_same_tiles_as_a_sort(spark, size, tiles, shape):
    rng = random.Random(size)
    keys = rng.sample([f"{p}{i}" for p in ("", "0", "00000", "ab", "é", "漢") for i in range(400)], size)
    values = {
        "spread": lambda: (rng.randrange(-(10**15), 10**15), rng.randrange(10**6)),
        "tied": lambda: (rng.choice([1, 1, 1, 2, 900]), rng.choice([3, 4, None][:2])),
        "constant": lambda: (7, 7),
    }[shape]
    df = spark.createDataFrame([(k, *values()) for k in keys], "k string, x long, y long").repartition(3)
    assert rows(found(df, tiles)) == rows(wanted(df, tiles))


def test_nulls_come_first(spark):
    made = [(None, 5, 1), ("", 5, 1), ("a", None, 1), ("b", None, 1), ("c", 1, 1), ("d", 9, 2)]
    df = spark.createDataFrame(made, "k string, x long, y long")
    assert rows(found(df, 3)) == rows(wanted(df, 3))


def test_segments_need_no_sort_over_all_customers(spark):
    rng = random.Random(8)
    made = [
        (str(i), f"{rng.randrange(300):010d}" if i % 3 else "hot", date(2024, 1, 1) + timedelta(days=rng.randrange(90)), rng.choice([10.0, 20.0, None]))
        for i in range(2000)
    ]
    orders = spark.createDataFrame(made, "VBELN string, KUNNR string, ERDAT date, NETWR double")
    segments = trends.rfm_segments(orders, date(2024, 6, 1))
    metrics = trends.rfm_metrics(orders, date(2024, 6, 1))
    scores = {"r_score": F.desc("recency_days"), "f_score": F.asc("frequency"), "m_score": F.asc("monetary")}
    sorted_scores = metrics.withColumns({n: F.ntile(5).over(Window.orderBy(o, F.asc("KUNNR"))) for n, o in scores.items()})
    assert rows(segments.select("KUNNR", *scores)) == rows(sorted_scores.select("KUNNR", *scores))
    plan = executed_plan(segments)
    assert "rangepartitioning" not in plan and "Exchange" not in plan and "Window" not in plan
