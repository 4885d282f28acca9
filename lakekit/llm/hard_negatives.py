"""Mining hard negatives: rows of another label whose scores lie in a window below an anchor's positive.

The anchors, in blocks, are tied into minimum spanning trees. A row's score with a child lies within the edge's length times
the row's norm of its score with the parent, so walking a tree from its root gives every child's scores bounds, and only
rows whose bounds overlap the child's window are scored again. Without a score the bounds themselves are passed on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.llm.common import stored
from lakekit.sources.workspace import fresh_dir

EVERY = 50
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # percent of the positive's score
SCALE = 256

# Anchors of a tree; bytes of trees that go to all tasks at a time; rows that are scored at a time once windows are narrow.
BLOCK = 1024
ROUND_BYTES = 32 << 20
SLICES = (64, 256, 1024)
DENSE = 0.25  # share of a slice from which all of it is scored
EXACT = float(1 << 52)
LEAST, MOST = -(1 << 62) * 2 + 1, (1 << 62) * 2 - 1  # scores beyond 64 bits are cut to these


def widened(x: np.ndarray) -> np.ndarray:
    """Not below what exact arithmetic would give."""
    return x * (1 + 1e-12) + 1e-3


class Tree:
    """Anchors with the edges of a minimum spanning tree: parent, length of the edge to it, and levels from the root."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        n = len(ids)
        self.parent, self.edge = np.zeros(n, np.int64), np.zeros(n)
        self.largest = float(np.sqrt((vectors * vectors).sum(1).max(initial=0)))
        depth = np.zeros(n, np.int64)
        if self.largest**2 < EXACT / 4:
            self._span(depth)
        self.levels = [np.flatnonzero(depth == d) for d in range(depth.max(initial=0) + 1)]

    def _span(self, depth: np.ndarray) -> None:
        """Prim's algorithm from the first anchor over exact squared distances."""
        products = self.vectors @ self.vectors.T
        squares = np.diagonal(products).copy()
        outside = np.ones(len(squares), bool)
        outside[0] = False
        nearest = squares + squares[0] - 2 * products[0]
        for _ in range(1, len(squares)):
            at = int(np.argmin(np.where(outside, nearest, np.inf)))
            outside[at] = False
            self.edge[at] = nearest[at]
            depth[at] = depth[self.parent[at]] + 1
            there = squares + squares[at] - 2 * products[at]
            closer = outside & (there < nearest)
            nearest[closer] = there[closer]
            self.parent[closer] = at
        self.edge = widened(np.sqrt(self.edge))


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products beyond what floating point holds, cut to 64 bits."""
    whole = np.array([[int(x) for x in r] for r in a.tolist()], object).reshape(a.shape)
    other = np.array([[int(x) for x in r] for r in b.tolist()], object).reshape(b.shape)
    return np.clip(whole @ other.T, LEAST, MOST).astype(np.int64)


def window_scores(tree: Tree, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, whether scored) of anchors by rows. Every score within its anchor's [low, high] is there."""
    width = max(rows.shape[1], tree.vectors.shape[1])
    rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    anchors = np.pad(tree.vectors, ((0, 0), (0, width - tree.vectors.shape[1])))
    norms = np.sqrt((rows * rows).sum(1))
    shape = len(anchors), len(rows)
    if not norms.max(initial=0) * tree.largest < EXACT / 4:
        return exact_products(anchors, rows), np.ones(shape, bool)
    norms = widened(norms)
    least, most = np.empty(shape), np.empty(shape)
    scored = np.zeros(shape, bool)
    for depth, level in enumerate(tree.levels):
        full = level
        if depth:
            parent, edge = tree.parent[level], tree.edge[level]
            reach = edge * norms.min()
            sure = (most[parent].min(1) + reach >= low[level]) & (least[parent].max(1) - reach <= high[level])
            full, level, parent, edge = level[sure], level[~sure], parent[~sure], edge[~sure]
            if len(level):
                slack = edge[:, None] * norms + 1
                below, above = least[parent] - slack, most[parent] + slack
                needed = (above >= low[level][:, None]) & (below <= high[level][:, None])
                dense = needed.mean(1) > DENSE
                full = np.concatenate([full, level[dense]])
                least[level], most[level] = below, above
                for node, some in zip(level[~dense].tolist(), needed[~dense], strict=True):
                    score = rows[some] @ anchors[node]
                    least[node, some] = most[node, some] = score
                    scored[node, some] = True
        least[full] = most[full] = anchors[full] @ rows.T
        scored[full] = True
    return least, scored


class Best:
    """The k first (score, id) of each of some keys: higher scores first, then smaller ids."""

    def __init__(self, keys: int, k: int):
        self.k = k
        self.scores = np.full((keys, k), LEAST - 1, np.int64)
        self.ids = np.full((keys, k), np.iinfo(np.int64).max)
        self.held = np.zeros(keys, np.int64)

    def threshold(self) -> np.ndarray:
        """What a score must reach to get in."""
        return self.scores[:, -1]

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(keys):
            return
        old = np.unique(keys)
        taken = np.arange(self.k) < self.held[old][:, None]
        keys = np.concatenate([np.repeat(old, self.held[old]), keys])
        scores = np.concatenate([self.scores[old][taken], scores])
        ids = np.concatenate([self.ids[old][taken], ids])
        order = np.lexsort((ids, ~scores, keys))
        keys, scores, ids = keys[order], scores[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        place = np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))
        first = place < self.k
        self.scores[keys[first], place[first]] = scores[first]
        self.ids[keys[first], place[first]] = ids[first]
        self.held[old] = np.minimum(np.diff(np.append(starts, len(keys))), self.k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key, place = np.nonzero(np.arange(self.k) < self.held[:, None])
        return key, self.ids[key, place], self.scores[key, place]


class Positives:
    """The best rows of its own label for each anchor of a tree."""

    def __init__(self, tree: Tree, k: int):
        self.tree, self.best = tree, Best(len(tree.ids), k)

    def add(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        tree, low = self.tree, self.best.threshold()
        score, scored = window_scores(tree, rows, low.astype(float), np.full(len(low), np.inf))
        same = (tree.labels[:, None] == labels) & (tree.ids[:, None] != ids)
        anchor, row = np.nonzero(scored & same & (score >= low[:, None]))
        self.best.add(anchor, score[anchor, row].astype(np.int64), ids[row])

    def found(self) -> tuple[np.ndarray, ...]:
        anchor, ids, scores = self.best.rows()
        return self.tree.ids[anchor], ids, scores


class Negatives:
    """The best rows of other labels in the window of each of an anchor's positives."""

    def __init__(self, tree: Tree, k: int, windows: np.ndarray):
        """windows: (anchor's place, slot, lowest, highest score) of each positive."""
        self.tree, self.windows, self.best = tree, windows, Best(len(windows), k)

    def add(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        tree = self.tree
        at, lowest, highest = self.windows[:, 0], np.maximum(self.windows[:, 2], self.best.threshold()), self.windows[:, 3]
        low, high = np.full(len(tree.ids), MOST), np.full(len(tree.ids), LEAST)
        np.minimum.at(low, at, lowest)
        np.maximum.at(high, at, highest)
        score, scored = window_scores(tree, rows, low.astype(float), high.astype(float))
        other = tree.labels[:, None] != labels
        anchor, row = np.nonzero(scored & other & (score >= low[:, None]) & (score <= high[:, None]))
        score = score[anchor, row].astype(np.int64)
        # The windows of an anchor stand together: its slots from first[anchor] on.
        order = np.argsort(at, kind="stable")
        first = np.searchsorted(at[order], anchor)
        for slot in range(int(np.bincount(at).max(initial=0))):
            there = np.minimum(first + slot, len(order) - 1)
            window = order[there]
            inside = (first + slot < len(order)) & (at[window] == anchor) & (score >= lowest[window]) & (score <= highest[window])
            self.best.add(window[inside], score[inside], ids[row[inside]])

    def found(self) -> tuple[np.ndarray, ...]:
        window, ids, scores = self.best.rows()
        return self.tree.ids[self.windows[window, 0]], self.windows[window, 1], ids, scores


def quantised(vectors: pa.ListArray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component; shorter vectors are filled with zeros."""
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(float))
    lengths = np.diff(vectors.offsets.to_numpy())
    width = int(lengths.max(initial=0))
    if len(values) == width * len(lengths):
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def take_part(vector: Column, label: Column, key: Column, scale: int) -> Column:
    """Rows with an id, a label and a vector of numbers that stay finite when scaled."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * F.lit(float(scale))) == float("inf")))
    return key.isNotNull() & label.isNotNull() & vector.isNotNull() & ~odd


def block_trees(anchors: DataFrame, scale: int, block: int = BLOCK) -> DataFrame:
    """Anchors in blocks, near ones together by the signs of their first components: (block, n, width, ids, labels, vectors).

    Numbers are packed as bytes; each block is a row. A block's tree is built where it is used.
    """
    signs = F.substring(F.concat_ws("", F.transform("vector", lambda x: F.when(x < 0, "0").otherwise("1"))), 1, 24)
    parts = max(1, -(-anchors.count() // block))
    near = anchors.withColumn("_signs", signs).repartitionByRange(parts, "_signs", "id").sortWithinPartitions("_signs", "id")
    schema = "block long, n long, width long, ids binary, labels binary, vectors binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        left: pa.Table | None = None
        for batch in batches:
            left = pa.Table.from_batches([batch]) if left is None else pa.concat_tables([left, pa.Table.from_batches([batch])])
            while left.num_rows > block:
                yield packed(left.slice(0, block), number)
                left, number = left.slice(block), number + 1
        if left is not None and left.num_rows:
            yield packed(left, number)

    def packed(some: pa.Table, number: int) -> pa.RecordBatch:
        vectors = quantised(some.column("vector").combine_chunks(), scale)
        columns = [some.column(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "label")] + [vectors.tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([x], pa.int64()) for x in (number, len(vectors), vectors.shape[1])] + [pa.array([x], pa.binary()) for x in columns],
            ["block", "n", "width", "ids", "labels", "vectors"],
        )

    return near.select("id", "label", "vector").mapInArrow(run, schema)


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"]).reshape(row["n"], row["width"])
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), vectors


def rounds(blocks: DataFrame, limit: int) -> list[tuple[int, int]]:
    """Ranges of block numbers whose trees together stay within a size, but for a block that exceeds it alone."""
    found: list[list[int]] = []
    size = 0
    for number, n, width in blocks.select("block", "n", "width").orderBy("block").collect():
        cost = n * (8 * width + 64)
        if not found or size + cost > limit:
            found.append([number, number])
            size = 0
        found[-1][1] = number
        size += cost
    return [(a, b) for a, b in found]


def over_all_rows(rows: DataFrame, scale: int, collectors: Callable[[], list], schema: str) -> DataFrame:
    """Every task runs its rows past collectors and then gives out what they found, one batch each."""
    names = T.StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, sizes = collectors(), list(SLICES)
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                some = batch.slice(start, sizes[0])
                start += some.num_rows
                sizes = sizes[1:] or sizes
                ids, labels = (some.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "label"))
                vectors = quantised(some.column("vector"), scale)
                for collector in ready:
                    collector.add(ids, labels, vectors)
        for collector in ready:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in collector.found()], names)

    return rows.mapInArrow(run, schema)


def best_of(found: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    first = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn(name, F.row_number().over(first)).where(F.col(name) <= k)


def mine_hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows whose id `every` divides.

    A score is the inner product of components floor(scale * x). An anchor's positives are its best rows of the same label,
    its negatives for one of them the best rows of other labels with low to high percent of the positive's score; equal
    scores go by the smaller id. A positive without negatives gives no rows.

    Ids and labels must be integers. Rows with a NULL id, label, vector or component, or one that isn't finite, take no
    part. Missing components of shorter vectors count as zero, empty vectors score 0. Rows with the same id all count as
    partners, but never of their own id; as an anchor an id counts once (the smallest label, then vector). Scores beyond 64
    bits are cut to them. An empty table gives no rows. Other columns don't matter.

    The anchors go to all tasks in rounds of a bounded size, each a pass over the whole table for the positives and one for
    the negatives; a task keeps the best few rows per anchor and gives those out at its end, for a window over them. Nothing
    pairs all rows, and no task needs more than a round's trees, their best rows and a slice of rows.
    """
    spark = vectors.sparkSession
    key, vector, label = vectors[id_col], vectors[vector_col], vectors[label_col]
    rows = vectors.where(take_part(vector, label, key, scale)).select(
        key.cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector")
    )
    anchors = stored(
        rows.where(F.col("id") % every == 0)
        .groupBy("id")
        .agg(F.min(F.struct("label", "vector")).alias("_row"))
        .select("id", "_row.label", "_row.vector"),
        "mine-anchors",
    )
    blocks = stored(block_trees(anchors, scale), "mine-blocks")
    pairs, triples = fresh_dir(spark, "mine-positives"), fresh_dir(spark, "mine-negatives")
    pair_schema = "anchor_id long, id long, score long"
    triple_schema = "anchor_id long, slot long, id long, score long"

    for number, (first, last) in enumerate(rounds(blocks, ROUND_BYTES)):
        packed = [r.asDict() for r in blocks.where(F.col("block").between(first, last)).collect()]
        sent = spark.sparkContext.broadcast(packed)

        def best_positives(sent=sent) -> list:
            return [Positives(Tree(*unpacked(r)), positives) for r in sent.value]

        found = over_all_rows(rows, scale, best_positives, pair_schema)
        best_of(found, ["anchor_id"], positives, "slot").write.parquet(f"{pairs}/round={number}")
        known = spark.read.parquet(f"{pairs}/round={number}").select("anchor_id", "slot", "score").toArrow()
        windows = spark.sparkContext.broadcast(windows_of(packed, known, low, high))

        def best_negatives(sent=sent, windows=windows) -> list:
            return [Negatives(Tree(*unpacked(r)), negatives, w) for r, w in zip(sent.value, windows.value, strict=True)]

        found = over_all_rows(rows, scale, best_negatives, triple_schema)
        best_of(found, ["anchor_id", "slot"], negatives, "rank").write.parquet(f"{triples}/round={number}")
        sent.unpersist()
        windows.unpersist()

    def written(path: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path) if anything else spark.createDataFrame([], schema)

    anything = not blocks.isEmpty()
    positive = written(pairs, f"{pair_schema}, slot int").select(
        "anchor_id", F.col("slot").cast("long").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    negative = written(triples, f"{triple_schema}, rank int").withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    return positive.join(negative, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def windows_of(packed: list[dict], known: pa.Table, low: int, high: int) -> list[np.ndarray]:
    """For each block the windows of its anchors' positives: (anchor's place, slot, lowest, highest score)."""
    order = np.argsort(known.column("anchor_id").to_numpy(), kind="stable")
    anchor, slot, score = (known.column(c).to_numpy()[order] for c in ("anchor_id", "slot", "score"))
    found = []
    for row in packed:
        ids = np.frombuffer(row["ids"], np.int64)
        starts, ends = np.searchsorted(anchor, ids), np.searchsorted(anchor, ids, "right")
        windows = [
            (place, int(slot[i]), max(LEAST, -(-low * int(score[i]) // 100)), min(MOST, high * int(score[i]) // 100))
            for place, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True))
            for i in range(a, b)
        ]
        found.append(np.array(windows, np.int64).reshape(-1, 4))
    return found


def relabelled(vectors: DataFrame) -> DataFrame:
    """The table with the labels of every seventh id moved by one, as the registered query wants it."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.withColumn("label", moved)


def oracle(vectors: str = "embeddings") -> str:
    """The same in DuckDB SQL, by scoring every row against every anchor."""
    return f"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q FROM {vectors}
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
            list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
        SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, id AS negative_id, positive_score,
            score AS negative_score FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
        QUALIFY row_number() OVER w <= {NEGATIVES}"""
