"""Result tables kept as partial aggregates of batches: a batch writes its own groups, a read adds them up.

Every batch stores one segment. Whenever a fixed number of segments of a level is full, they are added up to one segment of
the next level, so that a read has few segments to add, and each group is written once per level instead of once per batch.
Which segments make up the table after a batch follows from the batch's number alone: its digits in base `fan`. Segments are
never changed, so a batch that is run again writes the same ones, and the table can be read as it was after any batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.sources.workspace import nothing_stored

FAN = 16


def segments_after(batch_id: int, fan: int) -> list[tuple[int, int]]:
    """(level, last batch) of the segments that together hold all batches up to one, the oldest first."""
    found, done, level = [], 0, 0
    while fan ** (level + 1) <= batch_id + 1:
        level += 1
    for at in range(level, -1, -1):
        width = fan**at
        while done + width <= batch_id + 1:
            done += width
            found.append((at, done - 1))
    return found


def completed_by(batch_id: int, fan: int) -> list[int]:
    """Levels above 0 of which a segment is full after this batch, the lowest first."""
    levels, at = [], 1
    while (batch_id + 1) % fan**at == 0:
        levels.append(at)
        at += 1
    return levels


@dataclass(frozen=True)
class PartialTable:
    """A table of groups under a folder.

    `merges` gives every measure the aggregate that adds up its partial values: F.sum for counts and decimal amounts, F.min,
    F.max, F.bit_or or F.bitmap_or_agg for others. Keys may be NULL. Measures must have one type at all levels: sums are cast
    back to the type that the batches bring.
    """

    path: str
    schema: T.StructType
    keys: Sequence[str]
    merges: Mapping[str, Callable[[str], Column]]
    fan: int = FAN

    def _segment(self, level: int, last: int) -> str:
        return f"{self.path}/segments/_level={level}/_last={last}"

    def _read(self, spark: SparkSession, segments: Sequence[tuple[int, int]]) -> DataFrame:
        """The rows of some segments. Batches that brought nothing have none."""
        there = spark.createDataFrame([], self.schema)
        if segments:
            try:
                stored = spark.read.schema(self._stored).option("basePath", f"{self.path}/segments").parquet(f"{self.path}/segments")
            except AnalysisException as error:
                if not nothing_stored(error):
                    raise
                return there
            wanted = F.lit(False)
            for level in {level for level, _ in segments}:
                lasts = [last for at, last in segments if at == level]
                wanted = wanted | ((F.col("_level") == level) & F.col("_last").isin(lasts))
            there = stored.where(wanted).select(*self.schema.names)
        return there

    @property
    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("_level", T.IntegerType()), T.StructField("_last", T.LongType())])

    def _merged(self, rows: DataFrame) -> DataFrame:
        added = [merge(c).cast(self.schema[c].dataType).alias(c) for c, merge in self.merges.items()]
        return rows.groupBy(*self.keys).agg(*added).select(*self.schema.names)

    def add(self, groups: DataFrame, batch_id: int) -> None:
        """Store the groups of a batch; batches are numbered from 0, and one that is added again replaces itself."""
        spark = groups.sparkSession
        groups.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).write.mode("overwrite").parquet(
            self._segment(0, batch_id)
        )
        for level in completed_by(batch_id, self.fan):
            width = self.fan ** (level - 1)
            parts = [(level - 1, batch_id - i * width) for i in range(self.fan)]
            self._merged(self._read(spark, parts)).write.mode("overwrite").parquet(self._segment(level, batch_id))
        spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id")).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/applied/_batch={batch_id}"
        )

    def last_batch(self, spark: SparkSession) -> int:
        """Number of the newest batch that is stored as a whole; -1 if there is none."""
        try:
            applied = spark.read.schema("batch_id long").parquet(f"{self.path}/applied")
        except AnalysisException as error:
            if not nothing_stored(error):
                raise
            return -1
        return applied.agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]

    def read(self, spark: SparkSession, after: int | None = None) -> DataFrame:
        """The table after the newest batch, or as it was after an earlier one."""
        last = self.last_batch(spark) if after is None else after
        return self._merged(self._read(spark, segments_after(last, self.fan) if last >= 0 else []))
