"""Packing tokenised documents into training sequences: concatenate and cut.

Two passes. The first tokenises every document once, stores its ids and, per task, the running number of tokens before
each document. Prefix sums over the tasks' totals, one row a task, make these numbers positions in the concatenation of
all documents. The second pass cuts the ids at fixed windows of these positions and writes one record per piece.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.llm.common import slices, stored, utf8
from lakekit.operators.joins import broadcast_if_small

SEQUENCE = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
# A text part that is encoded at a time, and the most ids of a stored row: a longer document takes several rows.
PART_BYTES = 4 << 20
ROW_TOKENS = 1 << 20
# Words whose ids a Python worker remembers; half of them go when they are full.
REMEMBERED = 400_000

BLANKS = (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")
BLANK = re.compile(rb"[\x20\x09-\x0D]")
ID_BYTES = 4

# How a tokenizer's file describes the words for which the quick way below is right.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# The same words of lower-case texts in ASCII and the letters of Latin-1, for which normal form C changes nothing; other
# letters, signs and the tokenizer's special tokens go to the tokenizer itself.
SIMPLE_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\x09-\x0d\x20a-z0-9ß-öø-ÿ]+")
NOT_SIMPLE = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ÿ]|<\|")
BETWEEN_BLANKS = re.compile(r"[^\x09-\x0d\x20]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if visible, else the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Known(dict):
    """Ids of words as bytes. A word that is asked for anew is encoded; the older half goes when there are too many."""

    def __init__(self, model):
        self.model, self.older, self.letters = model, {}, byte_letters()

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            letters = word if word.isascii() and word.isprintable() else "".join(map(self.letters.__getitem__, word.encode()))
            ids = packed([t.id for t in self.model.tokenize(letters)])
        if len(self) >= REMEMBERED // 2:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Encoder:
    """Ids of texts, as bytes. Where words are split as described above, equal words are encoded once."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use all cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as file:
            about = json.load(file)
        split, level = ([*((about["pre_tokenizer"] or {}).get("pretokenizers") or []), {}, {}])[:2]
        normalizers = [n["type"] for n in (about["normalizer"] or {}).get("normalizers") or []]
        self.by_words = (
            split.get("pattern") == {"Regex": WORDS}
            and normalizers == NORMALIZERS
            and (level.get("type"), level.get("use_regex"), level.get("add_prefix_space")) == ("ByteLevel", False, False)
        )
        self.known = Known(self.tokenizer.model)

    def _whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _simple(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, SIMPLE_WORD.findall(text.lower())))

    def encode(self, text: bytes) -> bytes:
        if not self.by_words:
            return self._whole(text.decode())
        done = []
        for part in parts(text):
            part = part.decode()
            if not NOT_SIMPLE.search(part):
                done.append(self._simple(part))
            else:
                done += [(self._whole if NOT_SIMPLE.search(c) else self._simple)(c) for c in BETWEEN_BLANKS.findall(part)]
        return b"".join(done)


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def parts(text: bytes, limit: int = PART_BYTES) -> Iterator[bytes]:
    """The text cut before ASCII blanks into parts up to a size, except where a longer stretch has none."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind(b, at + 1, at + limit) for b in BLANKS)
        if cut < 0:
            found = BLANK.search(text, at + limit)
            if not found:
                break
            cut = found.start()
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def windows(position: int, total: int, size: int) -> tuple[int, int, int]:
    """(sequence, offset in it, position of its end) of a position among `total`.

    Windows of `size` from the start. What is left for the last one is cut into powers of two, the largest first, so that
    no sequence has to be padded.
    """
    whole = total // size
    if position < whole * size:
        sequence = position // size
        return sequence, position - sequence * size, (sequence + 1) * size
    sequence, start = whole, whole * size
    while True:
        end = start + (1 << ((total - start).bit_length() - 1))
        if position < end:
            return sequence, position - start, end
        sequence, start = sequence + 1, end


def tokenise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Ids of every document with the end id: (doc_id, start, doc_tokens, n, ids, part, before).

    A row holds up to a million ids of a document from its `start`, as little-endian unsigned 32-bit numbers. `part` is
    the task, `before` the tokens of the task's earlier rows. The rows must be stored before they are read twice.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("start", "doc_tokens", "n")]
        + [T.StructField("ids", T.BinaryType()), T.StructField("part", T.LongType()), T.StructField("before", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        encode, end = encoder(vocabulary or default_vocabulary()).encode, packed([end_id])
        for batch in slices(batches, "_text", PART_BYTES):
            rows = []
            for i, text in enumerate(utf8(batch, "_text")):
                ids = encode(text) + end
                tokens = len(ids) // ID_BYTES
                for start in range(0, tokens, ROW_TOKENS):
                    some = ids[start * ID_BYTES : (start + ROW_TOKENS) * ID_BYTES]
                    n = len(some) // ID_BYTES
                    rows.append((i, start, tokens, n, some, before))
                    before += n
            at, start, tokens, n, data, earlier = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at))]
                + [pa.array(x, pa.int64()) for x in (start, tokens, n)]
                + [pa.array(data, pa.binary()), pa.array([part] * len(rows), pa.int64()), pa.array(earlier, pa.int64())],
                schema.names,
            )

    chosen = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("_text"))
    return chosen.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE,
    vocabulary: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece of a document: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    Every document's ids, closed by the end id, follow one another in the order of the table's files; sequences are
    windows of `size` ids over that, so each but the last ones is full, and those have powers of two as lengths. A piece
    lies in one sequence, `offset` ids from its start, and `start` ids from its document's. Documents are cut at the ends
    of windows, and after every million ids. `ids` are little-endian unsigned 32-bit numbers.

    A NULL or empty text is the end id alone. Repeated rows of an id are packed each. An empty table gives no rows. Other
    columns don't matter. The same files read in the same splits give the same sequences.

    Texts are tokenised once and their ids stored in the shared folder. A task holds the ids of one document; a stretch
    without ASCII blanks is encoded whole. The second pass needs one number per task of the first, broadcast only below
    the size limit of such sides.
    """
    kind = docs.schema[id_col].dataType
    tokens = stored(tokenise(docs, id_col, text_col, vocabulary, end_id), "pack-tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tokens.groupBy("part")
        .agg(F.sum("n").alias("_n"))
        .select(
            "part",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"),
            F.sum("_n").over(Window.partitionBy()).alias("total"),
        )
    )
    placed = tokens.join(broadcast_if_small(stored(offsets, "pack-offsets")), "part").select(
        "doc_id", "start", "doc_tokens", "n", "ids", (F.col("_base") + F.col("before")).alias("position"), "total"
    )
    numbers = ("start", "length", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType(
        [T.StructField("doc_id", kind), T.StructField("ids", T.BinaryType())] + [T.StructField(c, T.LongType()) for c in numbers]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("start", "doc_tokens", "n", "ids", "position", "total")]
            for i, (start, tokens, n, ids, position, total) in enumerate(zip(*columns, strict=True)):
                done = 0
                while done < n:
                    sequence, offset, end = windows(position + done, total, size)
                    length = min(n - done, end - position - done)
                    piece = ids[done * ID_BYTES : (done + length) * ID_BYTES]
                    rows.append((i, piece, start + done, length, tokens, sequence, offset))
                    done += length
            at, ids, *rest = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at)), pa.array(ids, pa.binary())] + [pa.array(x, pa.int64()) for x in rest],
                schema.names,
            )

    return placed.mapInArrow(run, schema).select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: (sequence_id, length, ids, boundaries), a boundary being (offset, doc_id, start, length).

    A sequence has at most as many pieces as ids, so what meets in a task is bounded by the sequence's size.
    """
    boundary = ("offset", "doc_id", "start", "length")
    grouped = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "start", "length", "ids", "doc_id"))).alias("_pieces"),
        F.sum("length").alias("length"),
    )
    return grouped.select(
        "sequence_id",
        "length",
        F.aggregate("_pieces", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"),
        F.transform("_pieces", lambda p: F.struct(*[p[c].alias(c) for c in boundary])).alias("boundaries"),
    )


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
