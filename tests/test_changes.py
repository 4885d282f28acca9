from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import executed_plan, rows
from pyspark.sql import functions as F

from lakekit.operators import changes, history
from lakekit.streaming.chains import EMPTY_SALES, sales_of_batch

NOW = datetime(2025, 6, 1)
KEYS = ["year", "month", "sales_org", "currency"]


@pytest.fixture
def before(spark):
    return spark.createDataFrame([(1, "ZOR", 10.0), (2, "OR", 20.0), (3, "ZOR", 30.0), (4, "RE", None)], "k int, t string, v double")


@pytest.fixture
def after(before):
    raised = changes.update_where(before, F.col("t") == "ZOR", {"v": F.col("v") * 2}).where("k <> 2")
    return raised.unionByName(before.sparkSession.createDataFrame([(9, "CR", 1.0)], before.schema))


def feed_of(before, after):
    return changes.change_feed(before, after, ["k"], 1, NOW)


def test_feed_has_both_images(before, after):
    counted = dict(rows(changes.change_counts(feed_of(before, after))))
    assert counted == {"insert": 1, "delete": 1, "update_preimage": 2, "update_postimage": 2}


def test_feed_of_equal_states_is_empty(before):
    assert feed_of(before, before).count() == 0


def test_applying_a_feed_gives_the_later_state(before, after):
    assert rows(changes.merge_changes(before, feed_of(before, after), ["k"], deletes=True)) == rows(after)


def test_applying_without_deletes_keeps_rows(before, after):
    kept = changes.merge_changes(before, feed_of(before, after), ["k"])
    assert {r.k for r in kept.collect()} == {1, 2, 3, 4, 9}


def test_upsert_twice_is_once(before, after):
    once = changes.merge_upsert(before, after, ["k"])
    assert rows(changes.merge_upsert(once, after, ["k"])) == rows(once)


def test_duplicate_source_keys_stop_the_job(before):
    with pytest.raises(Exception, match="duplicate key"):
        changes.merge_upsert(before, before.unionByName(before), ["k"]).collect()
    with pytest.raises(Exception, match="duplicate key"):
        feed_of(before, before.unionByName(before)).collect()


def test_latest_change_of_a_commit_is_deterministic(spark):
    feed = spark.createDataFrame(
        [(1, i, "insert", 2, NOW) for i in (3, 1, 2)],
        "k int, v int, _change_type string, _commit_version long, _commit_timestamp timestamp_ntz",
    )
    merged = changes.merge_changes(spark.createDataFrame([], "k int, v int"), feed, ["k"])
    assert rows(merged) == [(1, 1)]


def test_savings(before, after):
    assert rows(changes.change_savings(after, feed_of(before, after))) == [(4, 3, 1)]


def test_appended_feed_needs_no_comparison(before):
    feed = changes.appended_feed(before, 3, NOW)
    assert rows(changes.change_counts(feed)) == [("insert", 4)]
    assert "Join" not in executed_plan(feed)


def orders(spark, entries):
    df = spark.createDataFrame(entries, "VBELN string, ERDAT date, VKORG string, NETWR double, WAERK string")
    return df


BATCH_1 = [
    ("9000000001", date(2025, 6, 1), "1000", 15200000.0, "COP"),
    ("9000000002", date(2025, 6, 5), "1000", 18500000.0, "COP"),
    ("9000000003", date(2025, 6, 10), "1000", 22100000.0, "COP"),
    ("9000000004", date(2025, 6, 3), "2000", 52000.0, "USD"),
    ("9000000005", date(2025, 6, 12), "2000", 67500.0, "USD"),
    ("9000000006", date(2025, 6, 1), "3000", 31400000.0, "COP"),
]
BATCH_2 = [
    ("9000000007", date(2025, 6, 20), "1000", 9800000.0, "COP"),
    ("9000000008", date(2025, 6, 22), "2000", 38000.0, "USD"),
]


def accumulate(target, batch):
    return changes.merge_accumulate(target, sales_of_batch(batch), KEYS, "num_orders", "total_revenue", "avg_order_value")


def test_second_batch_is_added_to_the_first(spark):
    first = accumulate(spark.createDataFrame([], EMPTY_SALES), orders(spark, BATCH_1))
    both = {(r.sales_org): r for r in accumulate(first, orders(spark, BATCH_2)).collect()}
    assert (both["1000"].num_orders, both["1000"].total_revenue) == (4, 65600000.0)
    assert both["1000"].avg_order_value == 16400000.0
    assert (both["2000"].num_orders, both["2000"].total_revenue) == (3, 157500.0)
    assert (both["3000"].num_orders, both["3000"].avg_order_value) == (1, 31400000.0)


def test_mean_is_weighted(spark):
    target = spark.createDataFrame([(2025, 1, "1000", "COP", 10, 100e6, 10e6)], EMPTY_SALES)
    batch = spark.createDataFrame(
        [(2025, 1, "1000", "COP", 3, 45e6)],
        "year int, month int, sales_org string, currency string, num_orders bigint, total_revenue double",
    )
    merged = changes.merge_accumulate(target, batch, KEYS, "num_orders", "total_revenue", "avg_order_value").first()
    assert round(merged.avg_order_value / 1e6, 2) == 11.15


def test_groups_without_news_and_unknown_columns(spark):
    target = spark.createDataFrame([("a", 1, 5.0, 5.0, "x")], "g string, n bigint, s double, m double, extra string")
    batch = spark.createDataFrame([("b", 2, 6.0)], "g string, n bigint, s double")
    merged = changes.merge_accumulate(target, batch, ["g"], "n", "s", "m")
    assert rows(merged) == [("a", 1, 5.0, 5.0, "x"), ("b", 2, 6.0, 3.0, None)]


def test_a_batch_is_not_applied_twice(spark):
    batch = spark.createDataFrame([("b1", 1), ("b2", 2)], "batch_id string, v int")
    ledger = spark.createDataFrame([("b1",)], "batch_id string")
    assert rows(changes.not_yet_applied(batch, ledger)) == [("b2", 2)]


def test_latest_batch(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 3)], "k int, w int")
    assert rows(changes.latest_batch(df, "w")) == [(2, 3), (3, 3)]


def test_damage_compare_restore(spark, before, tmp_path):
    path = str(tmp_path / "table")
    history.write_version(before, path, 0, "CREATE", datetime(2024, 1, 1))
    damaged = changes.update_where(before, F.lit(True), {"t": F.lit("XXX")})
    history.write_version(damaged, path, 1, "UPDATE", datetime(2024, 1, 2))
    measures = (F.count(F.lit(1)).alias("n"), F.count_distinct("t").alias("types"))
    assert rows(history.snapshot_compare(spark, path, (0, 1), *measures)) == [(0, 4, 3), (1, 4, 1)]
    assert history.snapshot_restore(spark, path, 0, datetime(2024, 1, 3)) == 2
    assert rows(history.snapshot_as_of(spark, path, 2)) == rows(before)
    assert rows(history.snapshot_as_of(spark, path, at=datetime(2024, 1, 2, 12))) == rows(damaged)
    assert [r.operation for r in history.snapshot_history(spark, path).orderBy("version").collect()] == [
        "CREATE",
        "UPDATE",
        "RESTORE 0",
    ]
    feed = history.change_feed_range(spark, path, ["k"], 1, 2)
    assert dict(rows(changes.change_counts(feed))) == {"update_preimage": 8, "update_postimage": 8}


def test_empty_states_are_recorded(spark, before, tmp_path):
    path = str(tmp_path / "table")
    history.write_version(before, path, 0, "CREATE", datetime(2024, 1, 1))
    history.write_version(before.where("false"), path, 1, "DELETE", datetime(2024, 1, 2))
    assert history.last_version(spark, path) == 1
    assert history.snapshot_as_of(spark, path, 1).count() == 0
    assert history.snapshot_as_of(spark, path, at=datetime(2024, 1, 5)).count() == 0
    feed = history.change_feed_range(spark, path, ["k"], 1, 1)
    assert rows(changes.change_counts(feed)) == [("delete", 4)]


def test_as_of_reads_one_folder(spark, before, tmp_path):
    path = str(tmp_path / "table")
    for version in range(3):
        history.write_version(before, path, version, "WRITE", datetime(2024, 1, 1 + version))
    plan = executed_plan(history.snapshot_as_of(spark, path, 1))
    assert "PartitionFilters: [isnotnull(_version" in plan


def test_rewriting_a_version_replaces_it(spark, before, tmp_path):
    path = str(tmp_path / "table")
    for _ in range(2):
        history.write_version(before, path, 0, "CREATE", datetime(2024, 1, 1))
    assert history.read_history(spark, path).count() == 4
    assert history.snapshot_history(spark, path).count() == 1


def test_only_existing_keys_are_scanned_for_a_small_batch(spark, before, monkeypatch):
    from lakekit.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_LIMIT", 200)
    monkeypatch.setattr(joins, "estimated_bytes", lambda df: 100 if df.count() < 3 else 1000)
    small = before.where("k = 1").unionByName(before.sparkSession.createDataFrame([(7, "x", 1.0)], before.schema))
    assert rows(joins.new_keys(small, before, ["k"])) == [(7, "x", 1.0)]


def test_keys_larger_than_their_files_are_not_broadcast(spark, tmp_path, monkeypatch):
    from lakekit.operators import joins

    def stored(first, last, name):
        key = F.concat(F.lit("order-" * 20), F.lpad(F.col("id").cast("string"), 10, "0")).alias("k")
        spark.range(first, last, 1, 1).select(key).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    target, candidates = stored(0, 40_000, "target"), stored(30_000, 50_000, "candidates")
    limit = joins.estimated_bytes(candidates)
    assert joins.estimated_bytes(target) > limit and joins.counted_bytes(candidates) > 4 * limit
    monkeypatch.setattr(joins, "BROADCAST_LIMIT", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = joins.new_keys(candidates, target, ["k"])
        assert new.count() == 10_000 and new.where("right(k, 10) < '0000040000'").count() == 0
        assert "Broadcast" not in executed_plan(new)
        few = joins.new_keys(candidates.where("right(k, 10) between '0000039999' and '0000040000'"), target, ["k"])
        assert [r.k[-10:] for r in few.collect()] == ["0000040000"]
        assert "BroadcastHashJoin" in executed_plan(few)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_keys_stay_apart(spark):
    """Eleven and twelve digits through a join and a distinct count."""
    from lakekit.functions.columns import pad_key

    keys = [10000000001, 10000000002, 100000000015]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").select(pad_key("k").alias("key"))
    assert df.distinct().count() == 3 and df.join(df.withColumnRenamed("key", "other"), F.col("key") == F.col("other")).count() == 3
