"""Mixing sources to target weights by hash thresholds: histograms find the cut, no document is sorted.

Every document has a hash. A source that is to give so many words takes all documents whose hash lies below a threshold.
The threshold is found by histograms of words over hash ranges: one over the whole range, then one over the single range
that holds the budget's end, and so on until one hash value is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
WIDTH = 12  # bits of the hash by which one histogram narrows a range


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def document_hash(key: Column, seed: str) -> Column:
    """60 bits of an MD5, the same in every run and engine."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """(source, source_size) to targets that share `share` of all words by weight.

    Weights go by the order of the sources, NULL last, and repeat. No target exceeds `cap` times its source; what that
    leaves is shared by weight among the others. In closed form: target = least(cap * size, level * weight), and the level
    comes from running sums over the sources in the order in which they reach their caps. One row per source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "position")
    position = F.row_number().over(ordered) - 1
    weighted = sizes.withColumn("position", position).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    )
    ranked = (
        weighted.withColumn("ratio", F.col("source_size") * F.lit(float(cap)) / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
        .withColumn("full", F.sum("source_size").over(by_ratio) - F.col("source_size"))
        .withColumn("left", F.sum("weight").over(Window.partitionBy()) - F.sum("weight").over(by_ratio) + F.col("weight"))
        .withColumn("level", (F.col("budget") - F.lit(float(cap)) * F.col("full")) / F.col("left"))
    )
    first = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "position", "level"))).over(Window.partitionBy())
    level = F.coalesce(first["level"], F.lit(float("inf")))
    return ranked.select(
        "source",
        "source_size",
        F.least(F.col("source_size") * F.lit(float(cap)), level * F.col("weight")).alias("target"),
    )


def _cut(sized: DataFrame, state: DataFrame, bits: int, width: int) -> DataFrame:
    """One refinement: of each source's range of 2**bits hashes, the part of 2**(bits - width) where its budget ends."""
    step = 1 << (bits - width)
    inside = (
        sized.join(state, "source_key")
        .where((F.col("hash") >= F.col("low")) & (F.col("hash") <= F.col("high")))
        .groupBy("source_key", F.floor((F.col("hash") - F.col("low")) / F.lit(step)).alias("bucket"))
        .agg(
            F.sum("size").alias("words"),
            F.min("hash").alias("first"),
            F.max("hash").alias("last"),
            F.any_value("low").alias("low"),
            F.any_value("below").alias("below"),
            F.any_value("rest").alias("rest"),
        )
    )
    running = F.sum("words").over(Window.partitionBy("source_key").orderBy("bucket"))
    reached = inside.withColumn("through", F.col("below") + running).where(F.col("through") >= F.col("rest"))
    return (
        reached.groupBy("source_key")
        .agg(F.min_by(F.struct("bucket", "words", "first", "last", "low", "through", "rest"), "bucket").alias("b"))
        .select(
            "source_key",
            (F.col("b.low") + F.col("b.bucket") * step).alias("low"),
            (F.col("b.low") + (F.col("b.bucket") + 1) * step - 1).alias("high"),
            (F.col("b.through") - F.col("b.words")).alias("below"),
            "b.rest",
            "b.words",
            "b.first",
            "b.last",
        )
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    width: int = WIDTH,
    seed: str = "mix:",
) -> DataFrame:
    """How many words of each document a mix of the sources takes: (id, size, source_size, target, taken).

    Size is the number of words. A source's target divided by its size gives the whole copies of all its documents; the
    rest comes from documents below a hash threshold, so one more copy of some. A document is taken whole each time.
    Documents with equal hashes (repeated rows of an id) go together; the last such group is taken if that brings the
    source nearer to its target. A NULL text has size 0, a NULL source is a source, a NULL id hashes as empty text.
    An empty table gives no rows. Reruns give the same rows. Other columns of the table don't matter.

    Sizes are computed once and stored (id, source, size, hash); every later pass reads that small table. Source counts
    and thresholds have one row per source. Nothing is sorted by hash, and nothing reaches the driver but a flag.
    """
    sized, limits = _sizes_and_limits(docs, id_col, text_col, source_col, weights, share, cap, width, seed)
    return sized.join(limits, "source_key").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies_taken()).alias("taken")
    )


def copies_taken() -> Column:
    """How often a document is taken, from its hash and its source's limits."""
    return F.col("copies") + F.when(F.col("hash") <= F.col("threshold"), F.lit(1)).otherwise(F.lit(0))


def source_key(source: Column) -> Column:
    """A source as a key that is never NULL."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix:") -> DataFrame:
    """The documents that `mix_sources` takes, with how often (copies), their words (size) and both multiplied (taken).

    The limits, one row per source, are joined to the documents, which are filtered where they are read. Documents that
    the mix leaves out go. Columns of the documents with these three names are replaced.
    """
    _, limits = _sizes_and_limits(docs, id_col, text_col, source_col, WEIGHTS, SHARE, CAP, WIDTH, seed)
    packed = docs.select(
        F.struct(*[c for c in docs.columns if c not in ("copies", "size", "taken")]).alias("_row"),
        source_key(docs[source_col]).alias("source_key"),
        document_hash(docs[id_col], seed).alias("hash"),
        word_count(docs[text_col]).alias("size"),
    )
    taken = packed.join(limits, "source_key").withColumn("copies", copies_taken()).where("copies > 0")
    return taken.select("_row.*", "copies", "size", (F.col("copies") * F.col("size")).alias("taken"))


def _sizes_and_limits(docs, id_col, text_col, source_col, weights, share, cap, width, seed) -> tuple[DataFrame, DataFrame]:
    """(the sized documents; per source: size, target, whole copies and the largest hash that gets one more)."""
    sized = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            source_key(F.col(source_col)).alias("source_key"),
            word_count(F.col(text_col)).alias("size"),
            document_hash(F.col(id_col), seed).alias("hash"),
        ),
        "mix-sizes",
    )
    sizes = sized.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes.drop("source_key"), weights, share, cap)
    keyed = targets.withColumn("source_key", source_key(F.col("source"))).drop("source")
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = stored(
        keyed.withColumn("copies", copies.cast("long")).withColumn(
            "rest", F.col("target") - F.col("copies") * F.col("source_size")
        ),
        "mix-goals",
    )
    state = goals.select(
        "source_key",
        F.lit(0).cast("long").alias("low"),
        F.lit((1 << HASH_BITS) - 1).cast("long").alias("high"),
        F.lit(0).cast("long").alias("below"),
        "rest",
    )
    bits = HASH_BITS
    while bits > 0:
        taken = min(width, bits)
        cut = stored(_cut(sized, state, bits, taken), "mix-cut")
        bits -= taken
        if cut.where(F.col("first") < F.col("last")).isEmpty():
            break
        state = cut.select("source_key", "low", "high", "below", "rest")
    nearer = F.col("below") + F.col("words") - F.col("rest") <= F.col("rest") - F.col("below")
    threshold = F.when(nearer, F.col("last")).otherwise(F.col("first") - 1)
    limits = goals.join(cut.select("source_key", threshold.alias("threshold")), "source_key", "left")
    return sized, limits


def oracle(docs: str = "documents", seed: str = "mix:") -> str:
    """The same mix in DuckDB SQL, by running sums over sorted hashes."""
    weight = "CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END"
    return f"""WITH sized AS (SELECT doc_id, source,
            len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
            ('0x' || md5('{seed}' || coalesce(doc_id::VARCHAR, ''))[1:15])::BIGINT AS hash FROM {docs}),
        sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
        weighted AS (SELECT *, {weight} AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS position FROM sources),
        ranked AS (SELECT *, 1.5 * sum(source_size) OVER () AS budget, source_size * 2.0 / weight AS ratio FROM weighted),
        levels AS (SELECT *, (budget::DOUBLE - 2.0 * (sum(source_size) OVER o - source_size)::DOUBLE)
            / (sum(weight) OVER () - sum(weight) OVER o + weight)::DOUBLE AS level
            FROM ranked WINDOW o AS (ORDER BY ratio, position)),
        chosen AS (SELECT arg_min(level, (ratio, position)) AS level FROM levels WHERE ratio >= level),
        goals AS (SELECT source, source_size, least(source_size * 2.0::DOUBLE, chosen.level * weight) AS target
            FROM levels, chosen),
        split AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM goals),
        run AS (SELECT d.doc_id, d.size, g.source_size, g.target, g.copies, g.target - g.copies * g.source_size AS rest,
            sum(d.size) OVER (PARTITION BY d.source ORDER BY hash RANGE UNBOUNDED PRECEDING) AS through,
            sum(d.size) OVER (PARTITION BY d.source, hash) AS tied
            FROM sized d JOIN split g ON d.source IS NOT DISTINCT FROM g.source)
        SELECT doc_id, size, source_size, target::DOUBLE AS target, (size * (copies + CASE WHEN through <= rest OR
            (through - tied < rest AND through - rest <= rest - (through - tied)) THEN 1 ELSE 0 END))::BIGINT AS taken FROM run"""
