"""Space-filling curve over columns: rows that are near in all columns at once get near numbers.

Each column's value is replaced by its quantile rank, and the ranks' bits are interleaved, the highest first (a Z-order
curve). A block of the curve, all places that begin with the same bits, is then narrow in every column, not only in the first
one as with a sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows from which quantiles are estimated, drawn at random from the whole table, and the most characters of their texts.
SAMPLE_ROWS = 100_000
SAMPLE_CHARACTERS = 64
MOST_BITS = 11


def ordinal(df: DataFrame, name: str) -> Column:
    """A value that sorts as the column does and can be written as a literal in any time zone."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, T.BooleanType):
        return column.cast("int")
    if isinstance(kind, T.StringType):
        return F.substring(column, 1, SAMPLE_CHARACTERS)
    if isinstance(kind, T.NumericType):
        return column
    raise ValueError(f"{name}: a column of type {kind.simpleString()} can't be clustered by")


def quantile_edges(df: DataFrame, columns: Sequence[str], ranks: int, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """For each column up to ranks - 1 distinct values that part its rows into about equal shares.

    Estimated from a random sample of bounded size; NULLs don't count. Only the edges reach the driver. Edges decide where
    rows lie, never whether they are there, so nothing depends on the sample being exact.
    """
    values = df.select(*[ordinal(df, c).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = df.count()
    drawn = values.sample(sample_rows / rows, seed=0) if rows > sample_rows else values
    sorted_values = [F.sort_array(F.collect_list(f"_{i}")) for i in range(len(columns))]

    def picked(values: Column) -> Column:
        places = F.transform(
            F.sequence(F.lit(1), F.lit(max(1, ranks - 1))), lambda r: F.floor(r * F.size(values) / F.lit(ranks)).cast("int")
        )
        return F.array_distinct(F.transform(F.filter(places, lambda p: p < F.size(values)), lambda p: F.get(values, p)))

    found = drawn.agg(*[v.alias(f"_{i}") for i, v in enumerate(sorted_values)]).select(
        *[picked(F.col(f"_{i}")).alias(f"_{i}") for i in range(len(columns))]
    )
    return dict(zip(columns, found.first(), strict=True))


def rank(value: Column, edges: Sequence) -> Column:
    """Number of edges not above the value, by nested comparisons; 0 for NULL."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(edges[middle]), among(middle + 1, high)).otherwise(among(low, middle))

    return among(0, len(edges))


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The ranks' bits as one number, highest bits first and the columns in turn."""
    total = F.lit(0).cast("long")
    for i, value in enumerate(ranks):
        wide = value.cast("long")
        for b in range(bits):
            bit = F.shiftright(wide, b).bitwiseAND(F.lit(1))
            total = total.bitwiseOR(F.shiftleft(bit, b * len(ranks) + len(ranks) - 1 - i))
    return total


def curve_position(df: DataFrame, columns: Sequence[str], bits: int) -> Column:
    """Place of a row on the curve over quantile ranks of `bits` bits a column.

    Columns with few different values use the highest bits of their rank, so that they part the rows as early as others.
    """
    edges = quantile_edges(df, columns, 1 << bits)
    aligned = [
        F.shiftleft(rank(ordinal(df, c), edges[c]), bits - len(edges[c]).bit_length() if edges[c] else 0) for c in columns
    ]
    return interleaved(aligned, bits)


# How much larger than the mean a file may be, and by how many bits blocks may be coarser or finer than one per file.
OVERFULL = 1.5
COARSER, FINER = 3, 3


def blocks_to_files(places: DataFrame, bits: int, files: int) -> DataFrame:
    """(cell, first_file, parts): which files the rows of each cell of the curve go to.

    `places` has the curve position of every row as `place`. Cells are blocks of the curve, some for every file. Blocks are
    joined with their neighbour as long as both fit into one file, so that files follow the blocks' borders; a cell that
    exceeds a file alone is dealt over several. One row per cell, at most 2 ** (FINER + 1) times the number of files.
    """
    level = max(1, ceil(log2(max(2, files))))
    finest = min(bits, level + FINER)
    counted = places.groupBy(F.shiftright("place", bits - finest).alias("cell")).agg(F.count(F.lit(1)).alias("rows"))
    depths = list(range(max(0, level - COARSER), finest + 1))
    sums = {f"_rows_{d}": F.sum("rows").over(Window.partitionBy(F.shiftright("cell", finest - d))) for d in depths}
    limit = F.col("_all") * F.lit(OVERFULL / files)
    sized = counted.withColumn("_all", F.sum("rows").over(Window.partitionBy()))
    for name, total in sums.items():
        sized = sized.withColumn(name, total)
    block = F.struct(F.lit(finest).alias("depth"), F.col("cell").alias("block"))
    for d in reversed(depths):
        fits = F.col(f"_rows_{d}") <= limit
        block = F.when(fits, F.struct(F.lit(d).alias("depth"), F.shiftright("cell", finest - d).alias("block"))).otherwise(block)
    shares = F.ceil(F.col("rows") * files / F.col("_all"))
    parts = F.when(F.col("rows") > limit, shares).otherwise(F.lit(1)).cast("int")
    in_order = Window.orderBy("cell")
    opens = F.when(F.lag("_block").over(in_order).eqNullSafe(F.col("_block")), F.lit(0)).otherwise(F.col("parts"))
    return (
        sized.select("cell", block.alias("_block"), parts.alias("parts"))
        .withColumn("_opens", opens)
        .withColumn("first_file", (F.sum("_opens").over(in_order) - F.col("parts")).cast("int"))
        .select("cell", "first_file", "parts")
    )


def rank_bits(columns: int, files: int) -> int:
    """Bits of a column's rank that suffice to tell that many files apart, and blocks some times finer."""
    return min(MOST_BITS, ceil((ceil(log2(max(2, files))) + FINER) / columns) + 1)
