"""Incremental ingestion of arriving files and tables with Structured Streaming.

A run takes what is new since its checkpoint and ends. Rows are written under one folder per micro-batch, replaced
if the batch is run again, so a restart never doubles rows.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.sources.workspace import nothing_stored

RESCUED = "_rescued_data"
RAGGED = "_corrupt_record"
# Files per micro-batch: bounds the list of names that one batch brings to the driver.
FILES_PER_BATCH = 10_000

BatchWriter = Callable[[DataFrame, int], None]


def write_batch(df: DataFrame, target: str, batch_id: int) -> None:
    """Store the rows of one micro-batch; running the batch again replaces them."""
    df.write.mode("overwrite").parquet(f"{target}/_batch={batch_id}")


def read_batches(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows ingested so far, with their batch number."""
    try:
        return spark.read.option("basePath", target).parquet(target)
    except AnalysisException as error:
        if schema is None or not nothing_stored(error):
            raise
        # The limit tells Catalyst that there are no rows; it would take the size for unknown, and so for huge.
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_batch", T.IntegerType())])).limit(0)


def _header(line: str, separator: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([line.lstrip("\ufeff")], delimiter=separator)))


def files_by_header(spark: SparkSession, paths: list[str], separator: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header line. One header per file reaches the driver, no data rows.

    The header is the first line of the block that starts a file; the aggregation keeps one line per file in every
    task.
    """
    first = (
        spark.read.text(paths)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
        .where("start = 0")
        .groupBy("path")
        .agg(F.min_by("value", "line").alias("header"))
    )
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in first.toLocalIterator():
        groups[_header(row.header, separator)].append(row.path)
    return dict(groups)


def rescue_unknown(
    spark: SparkSession, paths: list[str], schema: T.StructType, separator: str = ","
) -> DataFrame:
    """CSV files read by column name into a fixed schema.

    Columns the schema does not know, values that cannot be cast, and whole lines with more or fewer values than
    their header go to a JSON text in `_rescued_data`; it is NULL for rows that fit. Missing columns are NULL.
    """
    parts = [
        _rescue_group(spark, files, header, schema, separator)
        for header, files in sorted(files_by_header(spark, paths, separator).items())
    ]
    return reduce(DataFrame.unionByName, parts)


def _rescue_group(
    spark: SparkSession, files: list[str], header: tuple[str, ...], schema: T.StructType, separator: str
) -> DataFrame:
    known = {f.name: f.dataType for f in schema.fields}
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in (*header, RAGGED)])
    raw = (
        spark.read.schema(as_text)
        .option("header", True)
        .option("sep", separator)
        .option("columnNameOfCorruptRecord", RAGGED)
        .csv(files)
    )

    def column(name: str) -> Column:
        return F.col(f"`{name}`")

    typed = [
        (column(name).try_cast(dtype) if name in header else F.lit(None).cast(dtype)).alias(name)
        for name, dtype in known.items()
    ]
    rescued = []
    for name in header:
        if name not in known:
            rescued.append(column(name).alias(name))
        elif not isinstance(known[name], T.StringType):
            lost = column(name).isNotNull() & column(name).try_cast(known[name]).isNull()
            rescued.append(F.when(lost, column(name)).alias(name))
    leftovers = F.nullif(F.to_json(F.struct(*rescued, column(RAGGED))), F.lit("{}"))
    return raw.select(
        *typed,
        leftovers.alias(RESCUED),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_name").alias("_source_file_name"),
    )


def rescue_monitor(df: DataFrame) -> DataFrame:
    """Rows of a table that needed rescuing."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count(RESCUED).alias("rescued_rows"))


def new_files(spark: SparkSession, landing: str, name_pattern: str) -> DataFrame:
    """Stream of the paths of arriving files; the content column is not read."""
    files = "path string, modificationTime timestamp, length long, content binary"
    return (
        spark.readStream.format("binaryFile")
        .schema(files)
        .option("pathGlobFilter", name_pattern)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .load(landing)
        .select("path")
    )


def incremental_files(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    checkpoint: str,
    target: str | None = None,
    name_pattern: str = "*.csv",
    on_batch: BatchWriter | None = None,
) -> None:
    """Ingest the files that arrived since the last run, then stop.

    Every micro-batch is rescued into the schema, stamped, and either stored under the target or handed on.
    """
    if (target is None) == (on_batch is None):
        raise ValueError("give a target folder or a batch function")

    def ingest(names: DataFrame, batch_id: int) -> None:
        paths = [row.path for row in names.toLocalIterator()]
        if not paths:
            return
        rows = rescue_unknown(names.sparkSession, paths, schema).withColumn("_ingested_at", F.current_timestamp())
        if on_batch:
            on_batch(rows, batch_id)
        else:
            write_batch(rows, target, batch_id)

    query = (
        new_files(spark, landing, name_pattern)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(ingest)
        .start()
    )
    query.awaitTermination()


def stream_table(spark: SparkSession, folder: str, schema: T.StructType, name_pattern: str = "*.parquet") -> DataFrame:
    """A Parquet table as a stream: rows of files that arrive."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", name_pattern)
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .parquet(folder)
    )


def stream_table_read(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    source: str,
    target: str,
    checkpoint: str,
    name_pattern: str = "*.parquet",
) -> None:
    """Append the rows that are new in a table to a bronze table, with ingest columns, then stop."""
    rows = stream_table(spark, folder, schema, name_pattern).withColumns(
        {"_ingested_at": F.current_timestamp(), "_source": F.lit(source)}
    )
    (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
