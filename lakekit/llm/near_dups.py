"""Near duplicates by fast similarity sketching: every coordinate of a sketch is filled in rounds of hashed bin placement.

In round i every shingle falls into a hashed bin with the value i plus a hash; a bin keeps its smallest value, so later
rounds only fill bins that are still empty. From round t on, all shingles go to the one bin of that round, so that each
bin is filled after 2t rounds at the latest. Coordinates of two sketches agree with the probability of their Jaccard
similarity, with concentration as if every coordinate were drawn anew. Bands of coordinates give candidates, and every
link is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.llm.common import LOWER, UPPER, slices, stored, utf8

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 40, 5  # a pair of similarity 0.8 shares no band with a probability of 1e-7
# One bit of each coordinate, 64 to a word. Bits of a pair of similarity s agree with probability (1 + s) / 2; a pair is
# left out only if its bits agree less than that by six standard deviations (1e-9).
SIGNATURE_WORDS = 3
DEVIATIONS = 6.0
# Parities of the elements in 512 hashed cells: two sets differ in at least as many elements as their parities in cells.
PARITY_WORDS = 8
STAR_ROUNDS = 3
ROWS_PER_SALT = 256
SIGNATURE = [f"s{i}" for i in range(SIGNATURE_WORDS)]
PARITIES = [f"p{i}" for i in range(PARITY_WORDS)]
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words make one shingle; none without words."""
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, text.lower().split()), np.uint64)
    n = len(words)
    if n == 0:
        return words
    k = min(n, size)
    total = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        total = mixed(total + words[j : n - k + 1 + j] * _ODD[j % len(_ODD)])
    return np.unique(total)


def fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """One row of t coordinates per set; all sets must have elements."""
    out = np.full((len(sets), t), np.iinfo(np.uint64).max, np.uint64)
    open_rows = np.arange(len(sets))
    flat = out.reshape(-1)
    with np.errstate(over="ignore"):
        elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(open_rows, [len(s) for s in sets])
        for i in range(2 * t):
            h = mixed(elements + np.uint64(i + 1) * _ODD[0])
            value = (np.uint64(i) << np.uint64(48)) | (mixed(h ^ _ODD[1]) >> np.uint64(16))  # rounds may be more than 256
            bins = (h % np.uint64(t)).astype(np.int64) if i < t else np.full(len(h), i - t)
            np.minimum.at(flat, owner * t + bins, value)
            unfilled = (out[open_rows] == np.iinfo(np.uint64).max).any(axis=1)
            if not unfilled.all():
                open_rows = open_rows[unfilled]
                if not len(open_rows):
                    break
                stay = np.isin(owner, open_rows)
                elements, owner = elements[stay], owner[stay]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key per band and set."""
    with np.errstate(over="ignore"):
        keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sketch), bands)).copy()
        for r in range(rows):
            keys = mixed(keys * _ODD[2] + sketch[:, r::rows][:, :bands])
    return keys.view(np.int64)


def signatures(sketch: np.ndarray, words: int = SIGNATURE_WORDS) -> np.ndarray:
    """One bit of each of the first coordinates, packed into 64-bit words."""
    bits = (mixed(sketch[:, : 64 * words]) & np.uint64(1)).reshape(len(sketch), words, 64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(axis=2, dtype=np.uint64).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """How many elements fall into each cell, modulo 2, packed into 64-bit words."""
    with np.errstate(over="ignore"):
        cells = (mixed(shingles + _ODD[3]) % np.uint64(64 * PARITY_WORDS)).astype(np.int64)
    odd = np.bincount(cells, minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def bits_apart(percent: int, words: int = SIGNATURE_WORDS) -> int:
    """Most bits in which signatures of a linked pair differ, but for a probability of 1e-9."""
    n, p = 64 * words, (1 - percent / 100) / 2
    return int(n * p + DEVIATIONS * (n * p * (1 - p)) ** 0.5) + 1


def sketch_documents(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, fp, bands, signature) per row; fp and bands are NULL without words. One pass over whole texts."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("text_hash", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("fp", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            *[T.StructField(c, T.LongType()) for c in SIGNATURE + PARITIES],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            sets = [shingle_set(t, shingle) for t in utf8(batch, "_text")]
            full = [s for s in sets if len(s)]
            drawn = sketches(full, bands * rows)
            keys = iter(band_keys(drawn, bands, rows).tolist())
            signed = np.zeros((len(sets), SIGNATURE_WORDS + PARITY_WORDS), np.int64)
            if full:
                signed[[i for i, s in enumerate(sets) if len(s)]] = np.hstack([signatures(drawn), [parities(s) for s in full]])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    *[pa.array(signed[:, i]) for i in range(signed.shape[1])],
                ],
                schema.names,
            )

    text = docs[text_col]
    chosen = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("_text"))
    return chosen.mapInArrow(run, schema)


def _confirmed(requests: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Edges (a, b) among pairs: rows of one center and salt stand together, the center's text first.

    A task holds one center's set and one member's at a time, however many members there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, None
        for batch in slices(batches, "text"):
            a, b = [], []
            columns = (batch.column(c).to_pylist() for c in ("center", "salt", "member", "fp"))
            for center, salt, member, fp, text in zip(*columns, utf8(batch, "text")):
                shingles = shingle_set(text, shingle)
                if not member:
                    group, own = (center, salt), shingles
                    continue
                assert group == (center, salt)
                common = len(np.intersect1d(own, shingles, assume_unique=True))
                if 100 * common >= percent * (len(own) + len(shingles) - common):
                    a.append(center)
                    b.append(fp)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return requests.mapInArrow(run, "a binary, b binary")


def _verify(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (center, member) that are similar enough, stored as edges."""
    sizes = pairs.groupBy("center").agg(F.ceil(F.count("*") / ROWS_PER_SALT).alias("salts"))
    salted = pairs.join(sizes, "center").select(
        F.col("member").alias("fp"), "center", F.pmod(F.hash("member"), F.col("salts")).alias("salt"), F.lit(True).alias("member")
    )
    centers = sizes.select(
        F.col("center").alias("fp"),
        "center",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
        F.lit(False).alias("member"),
    )
    requests = salted.unionByName(centers).join(texts, "fp")
    dealt = requests.repartition("center", "salt").sortWithinPartitions("center", "salt", "member")
    return stored(_confirmed(dealt, shingle, percent).distinct(), "near-edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the edges (a, b): the root is the same for all nodes that are connected.

    Every node points to its smallest neighbour; pointers are followed, edges are drawn between the roots, and so on
    until no edge is left. The edges at least halve from round to round.
    """
    labels = None
    left = edges
    while True:
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("p"))
        parents = parents.select("node", F.least("node", "p").alias("root"))
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        jumped = stored(parents.join(up, "root").select("node", F.col("higher").alias("root")), "near-parents")
        if labels is None:
            labels = jumped
        else:
            step = jumped.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            moved = labels.join(step, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
            labels = stored(moved, "near-labels")
        ends = jumped.select(F.col("node"), F.col("root"))
        drawn = left.join(ends.toDF("a", "ra"), "a").join(ends.toDF("b", "rb"), "b")
        drawn = drawn.where(F.col("ra") != F.col("rb")).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        left = stored(drawn.distinct(), "near-left")
        if left.isEmpty():
            return labels


def link_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row: documents linked by similar shingle sets.

    A document's set holds its distinct shingles of `shingle` words (blank-separated, A-Z lower case); fewer words make
    one shingle. Documents whose sets have a Jaccard similarity of at least `percent` per cent are linked, and a
    component's id is its smallest doc_id. Without words (NULL, empty, blank) a document is linked with nothing. Rows of
    one id are compared by their texts: equal ones are one document, different ones are linked only if similar. An id
    NULL is larger than all others and is its component's id only if there is no other. Other columns don't matter.

    Equal sets are one class from the start, however many rows have them. In every band bucket all classes are compared
    with one center; after the components of a few such rounds, only classes outside a bucket's largest component are
    compared with all others of the bucket outside their own. So no pair within a component is needed to find it, and
    yet no link between two components is missed.
    """
    rows_, classes, labels = _classes_and_roots(docs, id_col, text_col, shingle, percent, bands, rows)
    rooted = classes.select("fp", "rep").join(labels.toDF("fp", "r"), "fp", "left")
    rooted = rooted.select("fp", "rep", F.coalesce("r", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    ids = rooted.join(smallest, "root").select("fp", "component_id")
    linked = rows_.join(ids, "fp", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One document of each component of `link_near_duplicates`, the one with the smallest id, with all its columns.

    Rows that have id and text in common are one document, of which one row stays, whichever columns differ besides.
    Documents without words are linked with nothing and stay. A NULL id comes after all others.
    """
    rows_, classes, labels = _classes_and_roots(docs, id_col, text_col, shingle, percent, BANDS, ROWS)
    firsts = classes.select("fp", order_of_class().alias("first")).join(labels.toDF("fp", "r"), "fp", "left")
    kept = firsts.groupBy(F.coalesce("r", "fp").alias("root")).agg(F.min("first").alias("first")).select("first.doc_id", "first.text_hash")
    wordless = rows_.where("n_shingles = 0").select("doc_id", "text_hash").distinct()
    # Ids by their hash, so that NULL is a value; with the text's hash, 128 bits tell documents apart. Grouping and join
    # have the same keys, so texts are shuffled once.
    chosen = kept.unionByName(wordless).select(F.xxhash64("doc_id").alias("_key"), F.col("text_hash").alias("_hash"))
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64(docs[id_col]).alias("_key"), F.xxhash64(docs[text_col]).alias("_hash"))
    single = keyed.groupBy("_key", "_hash").agg(F.any_value("_row").alias("_row"))
    return single.join(chosen, ["_key", "_hash"], "left_semi").select("_row.*")


def order_of_class() -> Column:
    """The class's first document: (whether the id is NULL, id, hash of the text)."""
    return F.struct(F.col("rep").isNull().alias("last"), F.col("rep").alias("doc_id"), "text_hash")


def _classes_and_roots(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, bands: int, rows: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with sketches, classes of equal sets, root of every class that is linked with another)."""
    rows_ = stored(sketch_documents(docs, id_col, text_col, shingle, bands, rows), "near-sketches")
    classes = stored(
        rows_.where("n_shingles > 0")
        .groupBy("fp")
        .agg(
            F.min("doc_id").alias("rep"),
            F.min_by("text_hash", F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("text_hash"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("bands").alias("bands"),
            *[F.any_value(c).alias(c) for c in SIGNATURE + PARITIES],
        ),
        "near-classes",
    )
    members = classes.select("fp", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    shape = F.struct("n", *SIGNATURE, *PARITIES)
    crowded = members.join(shared.select("key"), "key")
    buckets = stored(crowded.join(classes.select("fp", shape.alias("shape")), "fp"), "near-buckets")
    wanted = buckets.select("fp").distinct().join(classes.select("fp", "rep", "text_hash"), "fp")
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    same = (wanted["text_hash"] == F.xxhash64(source["text"])) & wanted["rep"].eqNullSafe(source["id"])
    texts = stored(wanted.join(source, same).groupBy("fp").agg(F.any_value("text").alias("text")), "near-texts")
    labels, edges, tried = None, None, None
    for turn in range(STAR_ROUNDS + 1):
        if labels is None:
            mixed_keys = buckets.select("key", "fp", "shape", F.col("fp").alias("root"))
        else:
            rooted = buckets.join(labels.toDF("fp", "r"), "fp", "left").select(
                "key", "fp", "shape", F.coalesce("r", "fp").alias("root")
            )
            spread = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y")
            mixed_keys = stored(rooted.join(spread.select("key"), "key"), "near-open")
            if mixed_keys.isEmpty():
                break
        if turn < STAR_ROUNDS:
            order = F.xxhash64("fp", F.lit(turn))
            centers = mixed_keys.groupBy("key").agg(F.min(F.struct(order, "fp", "shape", "root")).alias("c"))
            candidates = mixed_keys.join(centers, "key").select(
                F.col("c.fp").alias("x"), F.col("c.shape").alias("xs"), F.col("c.root").alias("xr"), "fp", "shape", "root"
            )
        else:
            counts = mixed_keys.groupBy("key", "root").agg(F.count("*").alias("c"))
            largest = counts.groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("most"))
            minority = mixed_keys.join(largest, "key").where(F.col("root") != F.col("most"))
            minority = minority.select("key", F.col("fp").alias("x"), F.col("shape").alias("xs"), F.col("root").alias("xr"))
            candidates = minority.join(mixed_keys, "key")
        n, xn = F.col("shape.n"), F.col("xs.n")

        def apart(columns: list[str]) -> Column:
            return sum((F.bit_count(F.col(f"shape.{c}").bitwiseXOR(F.col(f"xs.{c}"))) for c in columns), F.lit(0))

        # A linked pair's elements that are in one set only are at most this share of both sizes.
        few = apart(PARITIES) * (100 + percent) <= (n + xn) * (100 - percent)
        likely = (n * 100 >= xn * percent) & (xn * 100 >= n * percent) & few & (apart(SIGNATURE) <= bits_apart(percent))
        pairs = (
            candidates.where((F.col("xr") != F.col("root")) & likely)
            .select(F.col("x").alias("center"), F.col("fp").alias("member"))
            .distinct()
            .withColumns({"low": F.least("center", "member"), "high": F.greatest("center", "member")})
        )
        if tried is not None:
            pairs = pairs.join(tried.select("low", "high"), ["low", "high"], "left_anti")
        pairs = stored(pairs, "near-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = _verify(pairs, texts, shingle, percent)
        edges = found if edges is None else edges.unionByName(found)
        labels = components(edges)
    return rows_, classes, labels


def oracle(docs: str = "documents", shingle: int = 4, percent: int = PERCENT) -> str:
    """The same components in DuckDB SQL: every pair with a common shingle, and a recursive closure of the links."""
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM {docs}),
        s AS (SELECT doc_id, unnest(list_distinct(CASE
            WHEN len(w) >= {shingle} THEN list_transform(range(1, len(w) - {shingle} + 2),
                lambda i: array_to_string(w[i : i + {shingle} - 1], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM d),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b USING (g)
            WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
            WHERE 100 * common >= {percent} * (a.n + b.n - common)),
        e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
        r AS (SELECT doc_id AS id, doc_id AS root FROM {docs} UNION SELECT e.y, r.root FROM r JOIN e ON r.id = e.x),
        c AS (SELECT id AS doc_id, min(root) AS component_id FROM r GROUP BY id)
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
        FROM c LEFT JOIN n USING (doc_id)"""
