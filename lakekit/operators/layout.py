"""Maintenance of table files: size report, compaction, clustered rewrite."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakekit.operators.curves import FINER, blocks_to_files, curve_position, rank_bits
from lakekit.operators.joins import broadcast_if_small
from lakekit.sources.workspace import written
from lakekit.values import SMALL_FILE_COUNT, SMALL_FILE_MB

MB = 1024 * 1024
TARGET_FILE_MB = 256


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every data file of a table; the listing is distributed and no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length")
    )


def file_health(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Files, size and small-file alarm of every table."""
    parts = [
        table_files(spark, path)
        .agg(F.count(F.lit(1)).alias("num_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("num_bytes"))
        .select(F.lit(name).alias("table_name"), "num_files", "num_bytes")
        for name, path in tables.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    mb_per_file = F.try_divide(F.col("num_bytes") / MB, F.col("num_files"))
    return report.select(
        "table_name",
        "num_files",
        F.round(F.col("num_bytes") / MB, 1).alias("size_mb"),
        F.round(mb_per_file, 2).alias("mb_per_file"),
        F.coalesce((mb_per_file < SMALL_FILE_MB) & (F.col("num_files") > SMALL_FILE_COUNT), F.lit(False)).alias(
            "small_files"
        ),
    )


def small_limit(target_mb: int) -> int:
    """Bytes below which a file is packed with others: any two such files fit into one of the target size."""
    return target_mb * MB // 2


def packing_plan(spark: SparkSession, path: str, target_mb: int = TARGET_FILE_MB) -> DataFrame:
    """(file, length, bin): the small files of a table in bins up to the target size, by the listed sizes alone.

    Files keep their folder's order, so what was written together stays together. Bins are numbered over all folders.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "")
    small = table_files(spark, path).where(F.col("length") < small_limit(target_mb)).select("path", folder.alias("folder"), "length")
    before = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    part = F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / F.lit(target_mb * MB))
    in_folder = small.withColumn("_part", part)
    number = F.dense_rank().over(Window.orderBy("folder", "_part")) - 1
    bins = in_folder.select("folder", "_part").distinct().withColumn("bin", number.cast("int"))
    return in_folder.join(bins, ["folder", "_part"]).select(F.col("path").alias("file"), "length", "bin")


def compact_files(
    spark: SparkSession,
    path: str,
    new_path: str,
    partition_by: Sequence[str] = (),
    target_mb: int = TARGET_FILE_MB,
) -> None:
    """Pack the small files of a table into files near the target size, in a new place. Larger files are left alone.

    Only files below half the target are read and rewritten, whole files to a bin and in their order; a partitioned table
    keeps its folders. `read_compacted` gives the table afterwards. One shuffle of the small files' rows.
    """
    plan = written(packing_plan(spark, path, target_mb), "packing-plan")
    table = spark.read.parquet(path)
    bins = plan.agg(F.max("bin")).first()[0]
    if bins is None:
        table.limit(0).write.mode("errorifexists").parquet(new_path)
        return
    name, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    small = table.where(F.col("_metadata.file_size") < small_limit(target_mb)).select("*", file_key(name).alias("_file"), row.alias("_row"))
    dealt = small.join(broadcast_if_small(plan.select(file_key(F.col("file")).alias("_file"), F.col("bin").alias("_bin"))), "_file")
    packed = dealt.repartitionById(bins + 1, F.col("_bin")).sortWithinPartitions(*partition_by, "_file", "_row")
    packed.select(*[f"`{c}`" for c in table.columns]).write.mode("errorifexists").partitionBy(*partition_by).parquet(new_path)


def file_key(name: Column) -> Column:
    """A file's name without scheme, host and escapes, which listings and scans write differently."""
    return F.regexp_replace(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?/+", "/")


def read_compacted(spark: SparkSession, path: str, new_path: str, target_mb: int = TARGET_FILE_MB) -> DataFrame:
    """A table whose small files were packed into a new place: its other files, where they were, and the packed ones.

    The small files are left out when the files are listed; they can be deleted.
    """
    large = spark.read.parquet(path).where(F.col("_metadata.file_size") >= small_limit(target_mb))
    return large.unionByName(spark.read.schema(large.schema).parquet(new_path))


def cluster_layout(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> str:
    """Rewrite rows so that close values of up to four filter columns share files and row groups.

    Files hold blocks of a space-filling curve over all the columns, so that their min/max are narrow in each, and a later
    filter on any one column skips most of them. Rows are counted by small blocks first; blocks are put together to about
    `files` files of similar size (the session's shuffle partitions, if none are named), and a block that holds much of the
    table is dealt over several by a hash of the row. Two passes over the filter columns, then one shuffle of the rows. One
    column alone needs no curve: its ranges, and a hash of the row within a value, give the files.
    """
    if not 1 <= len(columns) <= 4:
        raise ValueError("cluster by one to four columns")
    spark = df.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    if len(columns) == 1:
        ranged = df.repartitionByRange(files, F.col(f"`{columns[0]}`"), row).sortWithinPartitions(f"`{columns[0]}`")
        ranged.write.mode("errorifexists").parquet(path)
        return path
    bits = rank_bits(len(columns), files)
    placed = df.withColumn("_place", curve_position(df, columns, bits))
    bits *= len(columns)
    plan = written(blocks_to_files(placed.select(F.col("_place").alias("place")), bits, files), "cluster-plan").toDF(
        "_cell_of_file", "_first_file", "_parts"
    )
    finest = min(bits, ceil(log2(max(2, files))) + FINER)
    number = F.col("_first_file") + F.pmod(row, F.col("_parts"))
    dealt = (
        placed.withColumn("_cell", F.shiftright("_place", bits - finest))
        .join(broadcast_if_small(plan), F.col("_cell") == F.col("_cell_of_file"))
        .withColumn("_file", number.cast("int"))
    )
    total = plan.agg(F.coalesce(F.max(F.col("_first_file") + F.col("_parts")), F.lit(1))).first()[0]
    ordered = dealt.repartitionById(total, F.col("_file")).sortWithinPartitions("_place")
    ordered.select(*[f"`{c}`" for c in df.columns]).write.mode("errorifexists").parquet(path)
    return path


def files_to_read(spark: SparkSession, path: str, probes: Mapping[str, Column]) -> DataFrame:
    """For each column and value: all files of a table, and those whose least and largest value don't rule the value out."""
    bounds = [F.min(c).alias(f"_least_{i}") for i, c in enumerate(probes)] + [F.max(c).alias(f"_most_{i}") for i, c in enumerate(probes)]
    by_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("_file")).agg(*bounds)
    inside = [
        F.count_if(value.between(F.col(f"_least_{i}"), F.col(f"_most_{i}"))).alias(f"_read_{i}")
        for i, value in enumerate(probes.values())
    ]
    counted = by_file.agg(F.count(F.lit(1)).alias("num_files"), *inside)
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_read_{i}").alias("files_read")) for i, c in enumerate(probes)])
    return counted.select("num_files", F.inline(each)).select("column", "num_files", "files_read")
