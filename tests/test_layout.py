from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from conftest import executed_plan, rows
from pyspark.sql import functions as F

from lakekit.operators import curves, layout

MB = 1024 * 1024


def sizes(spark, path):
    return [r[0] for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().select("count").collect()]


def read_share(spark, path, probes):
    found = layout.files_to_read(spark, path, {c: F.lit(v) for c, v in probes.items()}).collect()
    return {r["column"]: r["files_read"] / r["num_files"] for r in found}


@pytest.mark.parametrize("columns", [["l_shipdate", "l_partkey", "l_extendedprice"], ["l_partkey", "l_shipdate"]])
def test_a_filter_on_any_column_skips_most_files(spark, folder, tmp_path, columns):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    path = layout.cluster_layout(lines, str(tmp_path / "c"), columns, files=64)
    assert rows(spark.read.parquet(path)) == rows(lines)
    per_file = sizes(spark, path)
    assert 40 <= len(per_file) <= 100 and max(per_file) <= 1.6 * lines.count() / 64
    for row in lines.orderBy(F.xxhash64(*lines.columns)).limit(5).collect():
        share = read_share(spark, path, {c: row[c] for c in columns})
        assert max(share.values()) <= 1 / 3, share
    # A sort by all columns, for comparison: the second column's filter reads nearly all files.
    lines.repartitionByRange(64, *columns).sortWithinPartitions(*columns).write.parquet(str(tmp_path / "sorted"))
    assert read_share(spark, str(tmp_path / "sorted"), {columns[1]: row[columns[1]]})[columns[1]] > 0.6


def test_four_columns_of_all_types(spark, tmp_path):
    start = datetime(2024, 1, 1)
    made = [
        (i, f"{i * 7919 % 5000:010d}", date(2024, 1, 1) + timedelta(days=i * 31 % 300), start + timedelta(minutes=i * 37 % 9999), i % 3 == 0, i / 7)
        for i in range(5000)
    ] + [(None,) * 6] * 50
    df = spark.createDataFrame(made, "n int, t string, d date, s timestamp_ntz, b boolean, v double")
    path = layout.cluster_layout(df, str(tmp_path / "c"), ["t", "d", "s", "b"], files=81)
    assert rows(spark.read.parquet(path)) == rows(df)
    assert read_share(spark, path, {"t": made[77][1], "d": made[77][2]})["t"] <= 0.5
    with pytest.raises(ValueError, match="can't be clustered"):
        layout.cluster_layout(df.withColumn("a", F.array("n")), str(tmp_path / "x"), ["a", "n"])


def test_hot_and_empty(spark, tmp_path):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 977).alias("g"), F.lit(1).alias("one"))
    path = layout.cluster_layout(df, str(tmp_path / "hot"), ["g", "one"], files=32)
    per_file = sizes(spark, path)
    assert sum(per_file) == 20_000 and max(per_file) <= 2 * 20_000 / 32
    empty = layout.cluster_layout(df.limit(0), str(tmp_path / "empty"), ["g", "id"], files=4)
    assert spark.read.schema(df.schema).parquet(empty).count() == 0


def test_curve_interleaves_ranks(spark):
    df = spark.range(16).select((F.col("id") % 4).alias("x"), F.floor(F.col("id") / 4).alias("y"))
    place = curves.interleaved([F.col("x"), F.col("y")], 2)
    want = {(x, y): sum(((x >> b) & 1) << (2 * b + 1) | ((y >> b) & 1) << (2 * b) for b in range(2)) for x in range(4) for y in range(4)}
    assert {(r.x, r.y): r.p for r in df.withColumn("p", place).collect()} == want


def noise(spark, low, high):
    return spark.range(low, high).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"), (F.col("id") % 2).alias("g"))


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_only_small_files_are_rewritten(spark, tmp_path, keys):
    old, new = str(tmp_path / "old with space+x"), str(tmp_path / "new")
    noise(spark, 0, 60_000).coalesce(1).write.partitionBy(*keys).parquet(old)  # files above half the target
    noise(spark, 60_000, 62_000).repartition(30).write.mode("append").partitionBy(*keys).parquet(old)
    folders = max(1, 2 * len(keys))
    before = layout.table_files(spark, old)
    large = before.where(F.col("length") >= layout.small_limit(2))
    assert (before.count(), large.count()) == (31 * folders, folders)
    layout.compact_files(spark, old, new, keys, target_mb=2)
    packed = layout.table_files(spark, new)
    assert packed.count() == folders
    assert packed.agg(F.sum("length")).first()[0] < MB / 2  # the small files' rows alone
    whole = layout.read_compacted(spark, old, new, target_mb=2)
    assert rows(whole.select("id", "t", "g")) == rows(noise(spark, 0, 62_000))
    layout.compact_files(spark, old, str(tmp_path / "again"), keys, target_mb=0)
    assert layout.table_files(spark, str(tmp_path / "again")).agg(F.sum("length")).first()[0] in (None, 0) or (
        spark.read.schema(whole.schema).parquet(str(tmp_path / "again")).count() == 0
    )


def test_small_files_are_pruned_when_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    noise(spark, 0, 40_000).coalesce(1).write.parquet(path)
    noise(spark, 40_000, 41_000).repartition(20).write.mode("append").parquet(path)
    scan = spark.read.parquet(path).where(F.col("_metadata.file_size") < layout.small_limit(2)).select("id")
    assert scan.count() == 1000
    scan.collect()
    metrics = scan._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert metrics.apply("numFiles").value() == 20
    assert "file_size" in executed_plan(scan)


def test_bins_keep_to_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    noise(spark, 0, 40_000).repartition(40).write.parquet(path)
    plan = layout.packing_plan(spark, path, target_mb=1)
    by_bin = [r[0] for r in plan.groupBy("bin").agg(F.sum("length")).orderBy("bin").select("sum(length)").collect()]
    assert len(by_bin) >= 2 and max(by_bin) <= 1.1 * MB and min(by_bin[:-1]) > 0.8 * MB


def test_columns_may_have_any_names(spark, tmp_path):
    df = spark.range(500).select(*[(F.col("id") * k % 97).alias(n) for k, n in enumerate(("cell", "parts", "first_file", "bin", "file", "a b"), 3)])
    path = layout.cluster_layout(df, str(tmp_path / "c"), ["cell", "a b"], files=4)
    layout.compact_files(spark, path, str(tmp_path / "p"))
    assert rows(spark.read.parquet(path)) == rows(layout.read_compacted(spark, path, str(tmp_path / "p"))) == rows(df)
