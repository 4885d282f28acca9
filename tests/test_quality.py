from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakekit.operators import quality
from lakekit.streaming.chains import facts_silver

RULES = lambda: {"positive": F.col("v") > 0, "named": F.col("n").isNotNull()}


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(1, 5.0, "a"), (2, -1.0, "b"), (3, None, None), (4, 1.0, None)], "k int, v double, n string")


def test_warn_keeps_rows_and_counts(facts):
    seen = Observation("warn")
    assert quality.expect_warn(facts, RULES(), seen).count() == 4
    assert seen.get == {"rows": 4, "positive": 2, "named": 2}


def test_drop_removes_broken_rows(facts):
    assert rows(quality.expect_drop(facts, RULES())) == [(1, 5.0, "a")]


def test_fail_stops(facts):
    # One row at a time: of rows in different tasks, whichever task fails first would name the error.
    for k, first in ((2, "positive"), (3, "positive"), (4, "named")):
        with pytest.raises(Exception, match=f"expectation failed: {first}"):
            quality.expect_fail(facts.where(F.col("k") == k), RULES()).select("k").collect()
    assert quality.expect_fail(facts.where("k = 1"), RULES()).count() == 1


def test_metrics(facts):
    assert rows(quality.expectation_metrics(facts, RULES())) == [("named", 2, 2), ("positive", 2, 2)]


def test_split_is_complete_and_disjoint(facts):
    valid, rejected = quality.quarantine_split(facts, RULES())
    assert rows(valid.unionByName(rejected.drop("failed_rules"))) == rows(facts)
    assert {r.k: r.failed_rules for r in rejected.collect()} == {2: ["positive"], 3: ["positive", "named"], 4: ["named"]}


@pytest.mark.parametrize("found, passes", [(0, True), (100, True), (101, False)])
def test_gate(spark, found, passes):
    if passes:
        assert quality.quality_gate(spark.range(found)) == found
    else:
        with pytest.raises(quality.QualityGateError, match="101 rows"):
            quality.quality_gate(spark.range(found))


def test_facts_without_zone_go_and_zero_distance_is_null(spark):
    df = spark.createDataFrame(
        [(1, 10.0, 4.0), (1, 10.0, 0.0), (None, 10.0, 1.0)], "zone int, amount double, distance double"
    ).withColumns({"happened_at": F.lit("2024-01-05 10:00:00").cast("timestamp_ntz"), "_ingested_at": F.localtimestamp()})
    kept = facts_silver(df).select("amount_per_distance").collect()
    assert sorted((r[0] for r in kept), key=str) == [2.5, None]
