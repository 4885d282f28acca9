"""Side-by-side run of registered queries: Spark against DuckDB on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame, SparkSession


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _shown(value) -> str:
    if isinstance(value, float):
        return repr(value + 0.0)
    return repr(value)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, sorted(tuple(_shown(v) for v in row) for row in df.select(*[f"`{c}`" for c in columns]).collect())


def duckdb_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    columns = sorted(names)
    order = [names.index(c) for c in columns]
    return columns, sorted(tuple(_shown(row[i]) for i in order) for row in result.fetchall())


def local_session(cpus: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
