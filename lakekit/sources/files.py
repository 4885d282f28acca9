"""Typed reads, staged CSV files, table writes and inventories."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.functions.columns import moment
from lakekit.sources.workspace import nothing_stored


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Header CSV with a declared schema: no inference job, zero-padded keys survive."""
    return spark.read.schema(schema).option("header", True).csv(paths)


def stage_csv(df: DataFrame, folder: str, files: int | None = None) -> str:
    """Write header CSV files to a staging folder; as many as there are partitions unless told otherwise."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").option("header", True).csv(folder)
    return folder


def binary_files(spark: SparkSession, folder: str, name_pattern: str = "*", content: bool = False) -> DataFrame:
    """Files as rows. The content is read only if asked for."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name_pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return files if content else files.select("path", "length", "modificationTime")


def with_file_lineage(df: DataFrame) -> DataFrame:
    """Path and name of the file each row came from; for DataFrames read from files."""
    return df.withColumns(
        {"_source_file": F.col("_metadata.file_path"), "_source_file_name": F.col("_metadata.file_name")}
    )


def bronze_ingest(
    df: DataFrame,
    source_file: str | Column,
    loaded_at: datetime | None = None,
    source_system: str | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """The rows as they came, plus audit columns."""
    name = F.lit(source_file) if isinstance(source_file, str) else source_file
    audit = {
        "_loaded_at": moment(loaded_at) if loaded_at else F.localtimestamp(),
        "_source_file": name,
    }
    if source_system:
        audit["_source_system"] = F.lit(source_system)
    if batch_id:
        audit["_batch_id"] = F.lit(batch_id)
    return df.withColumns(audit)


def write_partitioned(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Overwrite a table, one folder per partition value.

    Rows are first brought together by partition value with a rebalance: a value that holds much of the table is
    split over several tasks and files, and small values do not leave one tiny file per task.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df.hint("rebalance", F.col(partition_by)).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return path


def bronze_ingest_all(
    tables: Mapping[str, DataFrame],
    partitions: Mapping[str, str | None],
    folder: str,
    loaded_at: datetime | None = None,
) -> dict[str, str]:
    """Write every table to the bronze layer under its partition column; returns the paths."""
    return {
        name: write_partitioned(
            bronze_ingest(df, f"{name}.csv", loaded_at), f"{folder}/{name.lower()}_bronze", partitions.get(name)
        )
        for name, df in tables.items()
    }


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if not nothing_stored(error):
            raise
        return False


def create_if_missing(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> str:
    """Build and write the table unless it is there; an existing one is not touched."""
    if table_exists(spark, path):
        return "existing"
    build().write.mode("errorifexists").parquet(path)
    return "created"


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Column comments kept in the schema; Parquet files carry them along."""
    return reduce(
        lambda d, item: d.withMetadata(item[0], {"comment": item[1]}), comments.items(), df
    )


def write_documented(df: DataFrame, path: str, comments: Mapping[str, str]) -> str:
    """Create a table from a query, with column comments."""
    with_comments(df, comments).write.mode("overwrite").parquet(path)
    return path


def create_documented_table(
    df: DataFrame, name: str, path: str, description: str, comments: Mapping[str, str], properties: Mapping[str, str]
) -> None:
    """Create a catalog table from a query, with a description, column comments and properties."""
    write_documented(df, path, comments)
    catalog = df.sparkSession.catalog
    catalog.createTable(name, path, "parquet", with_comments(df, comments).schema, description)
    for key, value in properties.items():
        df.sparkSession.sql(
            "ALTER TABLE IDENTIFIER(:name) SET TBLPROPERTIES ({key} = {value})".format(
                key=_quoted(key), value=_quoted(value)
            ),
            args={"name": name},
        )


def _quoted(text: str) -> str:
    """Text as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def column_comments(df: DataFrame) -> dict[str, str | None]:
    return {f.name: f.metadata.get("comment") for f in df.schema.fields}


class SchemaDrift(ValueError):
    """The rows to append do not have the columns of the table."""


def append_strict(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Append rows; names and types must be those of the table."""
    have = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
    new = {f.name: f.dataType for f in df.schema.fields}
    if have != new:
        drift = sorted(n for n in have.keys() | new.keys() if have.get(n) != new.get(n))
        raise SchemaDrift(f"columns differ from the table: {', '.join(drift)}")
    df.select(*have).write.mode("append").parquet(path)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows that may bring new columns; read the table with read_evolved."""
    df.write.mode("append").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """All columns any file of the table has; NULL where a file lacks one."""
    return spark.read.option("mergeSchema", True).parquet(path)


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """The same without files: both inputs stacked, missing columns NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def _rows_by_name(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every table that has any: one aggregation over all of them, of which no column is read."""
    named = [df.select(F.lit(name).alias("name")) for name, df in tables.items()]
    return reduce(DataFrame.unionAll, named).groupBy("name").agg(F.count(F.lit(1)).alias("num_rows"))


def source_inventory(spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """One row per source: rows, columns and state. A source that cannot be read is a row, not a failure."""
    found: dict[str, DataFrame] = {}
    for name, read in sources.items():
        try:
            found[name] = read()
        except AnalysisException:
            continue
    listed = [(name, len(found[name].columns) if name in found else None) for name in sources]
    states = spark.createDataFrame(listed, "name string, num_columns int")
    ok = F.col("num_columns").isNotNull()
    counted = states.join(_rows_by_name(found), "name", "left") if found else states.withColumn("num_rows", F.lit(0))
    return counted.select(
        F.col("name").alias("source"),
        F.when(ok, F.coalesce("num_rows", F.lit(0))).cast("bigint").alias("num_rows"),
        "num_columns",
        F.when(ok, "ok").otherwise("missing").alias("status"),
    )


def layer_of(name: str) -> str:
    """Layer of a table by its name."""
    lowered = name.lower()
    if "_bronze" in lowered:
        return "BRONZE"
    if "_silver" in lowered:
        return "SILVER"
    if "gold_" in lowered or lowered.endswith("_gold"):
        return "GOLD"
    return "OTHER"


def layer_inventory(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its layer and rows, one per layer, and one for everything."""
    listed = spark.createDataFrame([(layer_of(n), n) for n in tables], "layer string, name string")
    return (
        listed.join(_rows_by_name(tables), "name", "left")
        .fillna(0, subset=["num_rows"])
        .rollup("layer", "name")
        .agg(F.sum("num_rows").alias("num_rows"), F.count(F.lit(1)).alias("num_tables"))
        .select(
            F.coalesce("layer", F.lit("ALL")).alias("layer"),
            F.coalesce("name", F.lit("ALL")).alias("table_name"),
            "num_rows",
            "num_tables",
        )
    )


def catalog_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """The tables of a database by name, for layer_inventory."""
    names: Iterable[str] = (t.name for t in spark.catalog.listTables(database))
    return {name: spark.table(f"{database}.{name}" if database else name) for name in names}


def land_batch(
    df: DataFrame, landing: str, batch_id: str, rows: int, newest_by: str | None = None, seed: int | None = None
) -> str:
    """Put one batch of rows into the landing area as CSV files under a folder of its own.

    The rows are the highest by a key, or drawn at random. Both are limits over a sort, so each task keeps only
    its best `rows` rows before they meet.
    """
    order = F.desc(newest_by) if newest_by else F.rand(seed)
    return stage_csv(df.orderBy(order).limit(rows), f"{landing}/batch_{batch_id}")
