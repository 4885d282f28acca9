"""Fill-in-the-middle: texts cut at two random boundaries that are looked up in a compressed set of all boundaries.

A text's boundaries are the byte offsets at which a unit starts, and its end. The set keeps them in containers of 65,536
offsets: sorted arrays where they are few, bitmaps where they are many, runs where they follow each other (ASCII texts
are one run). Running counts over the containers find the container of the k-th boundary, a local select finds its offset.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.llm.common import slices, utf8

SEED = "1:"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # percent of the documents that are cut; the others stay plain
SPM_BELOW = 20  # percent of the cut documents that start with the suffix
UNITS = ("code_point", "word", "line")

CONTAINER_BITS = 16
CONTAINER = 1 << CONTAINER_BITS
# An array takes two bytes an offset, a run four, a bitmap always 8 KiB.
ARRAY_MAX = 4096
BITMAP_BYTES = CONTAINER // 8
BLOCK = 64  # bytes of a bitmap per running count


class Array:
    """Few offsets, sorted."""

    def __init__(self, mask: np.ndarray):
        self.low = np.flatnonzero(mask).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class Bitmap:
    """One bit per offset, with the number of set bits before each block."""

    def __init__(self, mask: np.ndarray):
        whole = np.zeros(CONTAINER, bool)
        whole[: len(mask)] = mask
        self.bits = np.packbits(whole)
        counts = np.bitwise_count(self.bits).reshape(-1, BLOCK).sum(1, dtype=np.int64)
        self.before = np.cumsum(counts) - counts

    def select(self, k: int) -> int:
        block = int(np.searchsorted(self.before, k, "right")) - 1
        inside = np.flatnonzero(np.unpackbits(self.bits[block * BLOCK : (block + 1) * BLOCK]))
        return block * BLOCK * 8 + int(inside[k - self.before[block]])


class Runs:
    """Stretches of consecutive offsets, with the number of offsets before each."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray):
        self.starts = starts
        counts = ends - starts
        self.before = np.cumsum(counts) - counts

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run] + k - self.before[run])


def container(mask: np.ndarray, count: int) -> Array | Bitmap | Runs:
    """The smallest of the three forms for the offsets at which the mask is set."""
    edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    first = [0] if mask[0] else []
    last = [len(mask)] if mask[-1] else []
    runs = (len(edges) + len(first) + len(last)) // 2
    if 4 * runs < min(2 * count, BITMAP_BYTES):
        bounds = np.concatenate([first, edges, last]).astype(np.int64).reshape(-1, 2)
        return Runs(bounds[:, 0], bounds[:, 1])
    return Array(mask) if count <= ARRAY_MAX else Bitmap(mask)


class BoundarySet:
    """A set of offsets from a mask over all of them."""

    def __init__(self, mask: np.ndarray):
        keys, containers, counts = [], [], []
        for at in range(0, len(mask), CONTAINER):
            part = mask[at : at + CONTAINER]
            count = int(np.count_nonzero(part))
            if count:
                keys.append(at)
                containers.append(container(part, count))
                counts.append(count)
        self.keys, self.containers = keys, containers
        self.through = np.cumsum(counts, dtype=np.int64)

    def __len__(self) -> int:
        return int(self.through[-1]) if self.keys else 0

    def select(self, k: int) -> int:
        """The k-th smallest offset, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.through, k, "right"))
        return self.keys[at] + self.containers[at].select(k - (int(self.through[at - 1]) if at else 0))


def boundaries(text: bytes, unit: str = "code_point") -> BoundarySet:
    """Where units start, and the end of the text. Words start after ASCII blanks, lines after a line feed."""
    data = np.frombuffer(text, np.uint8)
    mask = np.ones(len(data) + 1, bool)
    if unit == "code_point":
        mask[:-1] = (data & 0xC0) != 0x80
    elif unit == "line":
        mask[1:-1] = data[:-1] == 10
    elif unit == "word":
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        mask[1:-1] = blank[:-1] & ~blank[1:]
    else:
        raise ValueError(f"unit {unit!r} is none of {UNITS}")
    return BoundarySet(mask)


def numbers(seed: str, key: str) -> tuple[int, ...]:
    """Four 32-bit numbers that depend on seed and key alone."""
    digest = hashlib.sha256((seed + key).encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def cut(text: bytes, key: str, unit: str, seed: str, marks: tuple[bytes, ...]) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, units of the prefix, units of the middle, output) of one text."""
    bounds = boundaries(text, unit)
    n = len(bounds) - 1
    h1, h2, h3, h4 = numbers(seed, key)
    if not text or h3 % 100 >= PLAIN_FROM or any(m in text for m in marks):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = bounds.select(first), bounds.select(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = marks
    if h4 % 100 < SPM_BELOW:
        return n, "spm", first, second - first, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", first, second - first, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "code_point",
    seed: str = SEED,
    marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """One row per row of the documents: (doc_id, n, form, prefix_units, middle_units, output).

    n is the number of units (code points, words with the blanks after them, or lines). The form is psm (marked prefix,
    suffix, middle), spm (suffix, prefix, middle) or plain (the text itself): empty texts, texts that contain a mark, and
    a tenth of the others by hash stay plain, with NULL units. Both cuts and the form follow from seed and id alone, so
    that repeated rows of an id are cut at the same places of equal texts, and reruns agree. A NULL text is empty, a NULL
    id hashes as empty text. An empty table gives no rows. Other columns don't matter. A text and its boundary set are
    held in one task (at most about twelve times the text's bytes while it is cut). One pass, no shuffle.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_units", T.LongType()),
            T.StructField("middle_units", T.LongType()),
            T.StructField("output", T.StringType()),
        ]
    )
    if unit not in UNITS:
        raise ValueError(f"unit {unit!r} is none of {UNITS}")
    encoded = tuple(m.encode() for m in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            keys = batch.column("_key").to_pylist()
            done = [cut(t, k, unit, seed, encoded) for t, k in zip(utf8(batch, "_text"), keys, strict=True)]
            n, form, prefix, middle, output = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                schema.names,
            )

    chosen = docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("_key"),
        docs[text_col].alias("_text"),
    )
    return chosen.mapInArrow(run, schema)


def restored(form: Column, output: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output was made of.

    Each mark occurs once in an output that isn't plain, since texts with a mark stay plain and no mark can start in one
    piece and end in another, or in a mark: marks must share no ending of one with a beginning of one.
    """
    p, s, m = marks
    head, middle = F.substring_index(output, m, 1), F.substring_index(output, m, -1)

    def after(part: Column, mark: str) -> Column:
        return F.substring_index(part, mark, -1)

    def first(part: Column, mark: str, until: str) -> Column:
        return F.substring(F.substring_index(part, until, 1), len(mark) + 1, 2**31 - 1)

    return (
        F.when(form == "psm", F.concat(first(head, p, s), middle, after(head, s)))
        .when(form == "spm", F.concat(after(head, p), middle, first(head, s, p)))
        .otherwise(output)
    )


def digests(cuts: DataFrame) -> DataFrame:
    """The cuts with hashes of the output and of the text restored from it in place of the output."""
    return cuts.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")).cast("binary"), 256).alias("restored_sha256"),
    )


def oracle(docs: str = "documents") -> str:
    """The same in DuckDB SQL, by counting code points from the start."""
    hashes = ", ".join(f"('0x' || h[{8 * i + 1}:{8 * i + 8}])::BIGINT AS h{i + 1}" for i in range(4))
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}' || coalesce(doc_id::VARCHAR, '')) AS h FROM {docs}),
        r AS (SELECT doc_id, t, length(t) AS n, {hashes} FROM d),
        c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN n = 0 OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}')
                OR h3 % 100 >= {PLAIN_FROM} THEN 'plain' WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM r),
        p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM c)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars,
            CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
                ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256,
            sha256(t) AS restored_sha256 FROM p"""
