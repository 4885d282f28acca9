"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.sources.workspace import fresh_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Texts that one step of a task holds as Python objects at a time.
SLICE_BYTES = 8 << 20


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared work folder and read back: cuts the lineage, and lost executors cost no rework."""
    path = fresh_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside give back the disk of their shuffles as soon as they end, not when the driver collects garbage.

    For jobs that store their rows: nothing reads their shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each piece stay below a size, except where one text alone is larger."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; NULL as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]
