"""Window jobs that stay distributed: global tiles, best rows per group with shares, latest row per key."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions.money import percent
from lakekit.sources.workspace import use_checkpoints


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row of the highest version per key; rows of one version are told apart by their other columns."""
    rest = [c for c in df.columns if c not in keys and c != version]
    newest = Window.partitionBy(*keys).orderBy(F.desc(version), *[F.asc_nulls_last(c) for c in rest])
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


# Parts a category is split into while its best items are sought.
CATEGORY_PARTS = 1024


def pareto_top_n(
    df: DataFrame, category: str, amount: str, key: str, n: int = 5, parts: int = CATEGORY_PARTS
) -> DataFrame:
    """Per category the items ranked up to n by amount (ties kept), with share and running share.

    The amount is a decimal per item. Categories are split into parts by item, so that one with very many items
    never meets in one task. Each part keeps its n best items and its total; the few kept items then meet by
    category, where the part totals add up to the category's. The running sum needs the kept items alone:
    everything ranked before them is kept too. All of it is one pass over the items.
    """
    part = Window.partitionBy(category, "_part")
    in_part = part.orderBy(F.desc(amount), F.asc(key))
    best_of_parts = (
        df.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts)))
        .withColumns(
            {
                "_part_row": F.row_number().over(in_part),
                "_part_rank": F.rank().over(part.orderBy(F.desc(amount))),
                "_part_total": F.sum(amount).over(part),
            }
        )
        .where(F.col("_part_rank") <= n)
    )
    whole = Window.partitionBy(category)
    running = whole.orderBy(F.desc(amount), F.asc(key)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        best_of_parts.withColumns(
            {
                "rank_categoria": F.rank().over(whole.orderBy(F.desc(amount))),
                "_total": F.sum(F.when(F.col("_part_row") == 1, F.col("_part_total"))).over(whole),
                "_running": F.sum(amount).over(running),
            }
        )
        .where(F.col("rank_categoria") <= n)
        .withColumns(
            {
                "pct_categoria": percent(F.col(amount), F.col("_total")),
                "pct_acumulado_pareto": percent(F.col("_running"), F.col("_total")),
            }
        )
        .drop("_part", "_part_row", "_part_rank", "_part_total", "_total", "_running")
    )


def global_position(df: DataFrame, order_by: Sequence[Column], name: str) -> DataFrame:
    """Position (from 0) of every row in one order over the whole table, without a one-task window.

    Rows are range-partitioned and sorted, and written to the checkpoint folder, so that every later read sees the
    same partitions even after a lost executor. A row's position is its place in its partition plus the rows of
    all partitions before it: one number per partition, so the joined side is as small as the partition count.
    """
    use_checkpoints(df.sparkSession)
    ordered = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
    )
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ordered.withColumns({"_part": part, "_place": place})
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_id", "_part", "_place", "_offset")
    )


def global_ntile(df: DataFrame, tiles: int, order_by: Sequence[Column], name: str) -> DataFrame:
    """ntile over the whole table. The first (rows mod tiles) tiles get one row more than the others."""
    placed = global_position(df, order_by, "_position")
    rows = placed.agg(F.count(F.lit(1))).scalar()
    small = F.floor(rows / tiles)
    larger = rows % tiles
    edge = larger * (small + 1)
    tile = F.when(
        F.col("_position") < edge, F.floor(F.col("_position") / (small + 1))
    ).otherwise(larger + F.floor(F.try_divide(F.col("_position") - edge, small)))
    return placed.withColumn(name, (tile + 1).cast("int")).drop("_position")


# Buckets of a histogram round, and characters by which a round looks further into tied keys.
HISTOGRAM_BUCKETS = 1 << 14
KEY_CHARACTERS = 3


@dataclass
class _Edge:
    """Search for the row at one position in the order (value, key): it lies in [low, high], `rank` rows after low's first."""

    measure: str
    rank: int
    low: int
    high: int
    prefix: str | None = None  # of the key, once the value is known
    key: str | None = None

    @property
    def known_value(self) -> bool:
        return self.low == self.high


def _found_buckets(rows: DataFrame, groups: dict, value_of: Callable, ranks: dict[str, list[tuple[int, int]]]) -> list:
    """Per edge the bucket of its group that holds the row of its rank: one scan, counted in every task first.

    `groups` maps a name to the condition of its rows, `value_of` a name to the bucket of a row, `ranks` a name to
    (number of the edge, rank in the group).
    """
    cells = F.array(*[F.when(c, F.struct(F.lit(g).alias("g"), value_of(g).alias("b"))) for g, c in groups.items()])
    counted = (
        rows.select("_key", F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("_c"))
        .groupBy("_c.g", "_c.b")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("_key").alias("least"), F.max("_key").alias("most"))
    )
    wanted = F.create_map(
        *[x for g, rs in ranks.items() for x in (F.lit(g), F.array(*[F.struct(F.lit(e).alias("edge"), F.lit(r).alias("rank")) for e, r in rs]))]
    )
    through = F.sum("rows").over(Window.partitionBy("g").orderBy("b"))
    each = counted.withColumn("through", through).withColumn("w", F.explode(wanted[F.col("g")]))
    held = (F.col("w.rank") < F.col("through")) & (F.col("w.rank") >= F.col("through") - F.col("rows"))
    return each.where(held).select("w.edge", "b", "rows", "least", "most", (F.col("w.rank") - F.col("through") + F.col("rows")).alias("rank")).collect()


def _common(a: str, b: str) -> str:
    return os.path.commonprefix([a, b])


def tile_edges(rows: DataFrame, tiles: int, measures: Sequence[str]) -> dict[str, list[tuple[int, str] | None]]:
    """For each measure the (value, key) of the first row of tiles 2, 3, ...; None for tiles without rows.

    `rows` has a text `_key` and whole-number measures, none NULL. A histogram over a measure's range finds the bucket with
    the wanted position, the next one looks into that bucket alone, down to a single value; rows tied at it are counted by
    the first characters of their keys, and so on. Every round is one scan with sums in the tasks; nothing is sorted.
    """
    bounds = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(m).alias(f"{name}_{m}") for m in measures for name, f in (("low", F.min), ("high", F.max))],
    ).first()
    n = bounds["n"]
    starts = [i * (n // tiles) + min(i, n % tiles) for i in range(1, tiles)]
    edges = [_Edge(m, s, bounds[f"low_{m}"], bounds[f"high_{m}"]) if s < n else None for m in measures for s in starts]
    while True:
        open_edges = [(i, e) for i, e in enumerate(edges) if e and not e.known_value]
        if not open_edges:
            break
        ranges = {f"{e.measure}:{e.low}:{e.high}": e for _, e in open_edges}
        width = {g: -(-(e.high - e.low + 1) // HISTOGRAM_BUCKETS) for g, e in ranges.items()}
        ranks: dict[str, list] = {g: [] for g in ranges}
        for i, e in open_edges:
            ranks[f"{e.measure}:{e.low}:{e.high}"].append((i, e.rank))
        inside = {g: F.col(e.measure).between(e.low, e.high) for g, e in ranges.items()}

        def bucket(g: str, ranges=ranges, width=width) -> Column:
            return F.expr(f"(`{ranges[g].measure}` - {ranges[g].low}L) div {width[g]}L")

        for found in _found_buckets(rows, inside, bucket, ranks):
            e = edges[found["edge"]]
            step = width[f"{e.measure}:{e.low}:{e.high}"]
            low = e.low + found["b"] * step
            edges[found["edge"]] = _Edge(e.measure, found["rank"], low, min(e.high, low + step - 1))
    for e in edges:
        if e:
            e.key, e.prefix = ("" if e.rank == 0 else None), ""
    while True:
        open_edges = [(i, e) for i, e in enumerate(edges) if e and e.key is None]
        if not open_edges:
            break
        names = {f"{e.measure}:{e.low}:{e.prefix}": e for _, e in open_edges}
        ranks = {g: [] for g in names}
        for i, e in open_edges:
            ranks[f"{e.measure}:{e.low}:{e.prefix}"].append((i, e.rank))
        tied = {g: (F.col(e.measure) == e.low) & F.col("_key").startswith(e.prefix) for g, e in names.items()}

        def longer(g: str, names=names) -> Column:
            return F.substring("_key", 1, len(names[g].prefix) + KEY_CHARACTERS)

        for found in _found_buckets(rows, tied, longer, ranks):
            e = edges[found["edge"]]
            if found["rank"] == 0 or found["least"] == found["most"]:
                e.key = found["least"]
            else:
                e.prefix, e.rank = _common(found["least"], found["most"]), found["rank"]
    per_measure = len(starts)
    return {
        m: [(e.low, e.key) if e else None for e in edges[i * per_measure : (i + 1) * per_measure]]
        for i, m in enumerate(measures)
    }


def tiles_by_histogram(df: DataFrame, tiles: int, measures: Mapping[str, Column], key: str) -> DataFrame:
    """ntile over the whole table for several measures at once, each by (measure, key), without sorting.

    `measures` are whole numbers in ascending order, NULL first; the key is text, NULL first. Rows with the same measure and
    key share a tile. The rows should be stored: they are scanned a few times, and the tiles are then comparisons with the
    edges.
    """
    names = [f"_measure_{i}" for i in range(len(measures))]
    least = F.lit(-(2**62))
    sort_key = F.when(F.col(key).isNull(), F.lit("")).otherwise(F.concat(F.lit("1"), F.col(key).cast("string")))
    values = [F.coalesce(m.cast("long"), least) for m in measures.values()]
    edges = tile_edges(df.select(sort_key.alias("_key"), *[v.alias(n) for n, v in zip(names, values, strict=True)]), tiles, names)

    def tile(value: Column, at: list[tuple[int, str] | None]) -> Column:
        reached = [
            ((value > e[0]) | ((value == e[0]) & (sort_key >= F.lit(e[1])))).cast("int") for e in at if e is not None
        ]
        return reduce(lambda a, b: a + b, reached, F.lit(1))

    return df.withColumns({name: tile(v, edges[n]) for name, v, n in zip(measures, values, names, strict=True)})
