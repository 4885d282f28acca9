"""Benchmark decontamination: a generalised suffix automaton of the test items reads the words of every document.

The automaton holds all substrings of all items. For each word of a document it tells the longest match that ends there;
a match of at least a window's length means that the words of the window stand in an item. Items are taken in blocks of a
bounded number of words, each block with an automaton of its own, so the broadcast doesn't grow with the test set.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm.common import slices, utf8

WINDOW = 10
BLOCK_WORDS = 200_000
# Bytes that are no part of a word become blanks, A-Z lower case.
_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class SuffixAutomaton:
    """All substrings of the items' word sequences; states know the items that hold their windows."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for name, words in items]
        for _, ids in items:
            last = 0
            for w in ids:
                last = self._extend(last, w)
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.top = list(range(len(self.link)))  # the state of the suffix of window length
        for s in order[1:]:
            if self.length[self.link[s]] >= window:
                self.top[s] = self.top[self.link[s]]
        self.holders: list[set[str]] = [set() for _ in self.link]
        self.short: list[dict[int, set[str]]] = [{} for _ in self.link]  # whole items shorter than a window, by length
        for name, ids in items:
            state = 0
            for i, w in enumerate(ids):
                state = self.next[state][w]
                if i + 1 >= window:
                    self.holders[self.top[state]].add(name)
            if 0 < len(ids) < window:
                self.short[state].setdefault(len(ids), set()).add(name)
        self.ends = [bool(x) for x in self.short]  # a short item ends here or at a suffix
        for s in order[1:]:
            self.ends[s] = self.ends[s] or self.ends[self.link[s]]
        self.shortest = min((len(ids) for _, ids in items if 0 < len(ids) < window), default=window)

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._state(self.length[last] + 1, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges [start, end) of words inside windows that occur, merged, and the items that have these windows.

        A word outside the vocabulary ends every match, so only runs of known words that are long enough are read.
        """
        known = bytes(map(self.vocabulary.__contains__, words))
        ranges: list[list[int]] = []
        found: set[str] = set()
        for run in re.finditer(rb"\x01{%d,}" % self.shortest, known):
            self._read(words, run.start(), run.end(), ranges, found)
        return _merged(ranges), found

    def _read(self, words, start: int, end: int, ranges: list[list[int]], found: set[str]) -> None:
        following, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for i in range(start, end):
            w = self.vocabulary[words[i]]
            while state and w not in following[state]:
                state = link[state]
                matched = length[state]
            if w in following[state]:
                state = following[state][w]
                matched += 1
            if matched >= window:
                found |= self.holders[self.top[state]]
                _mark(ranges, i + 1 - window, i + 1)
            if self.ends[state]:
                s = state
                while s > 0 and self.ends[s]:
                    for n, names in self.short[s].items():
                        if n <= matched:
                            found |= names
                            _mark(ranges, i + 1 - n, i + 1)
                    s = link[s]


def _mark(ranges: list[list[int]], start: int, end: int) -> None:
    if ranges and start <= ranges[-1][1]:
        ranges[-1][0] = min(ranges[-1][0], start)
        ranges[-1][1] = max(ranges[-1][1], end)
    else:
        ranges.append([start, end])


def _merged(ranges) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        _mark(out, start, end)
    return [(a, b) for a, b in out]


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of at most so many words (or one item), a partition at a time through the driver."""
    block, held = [], 0
    for name, text in items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_col).toLocalIterator():
        words = words_of((text or "").encode())
        if block and held + len(words) > block_words:
            yield block
            block, held = [], 0
        block.append((name, words))
        held += len(words)
    if block:
        yield block


def _pass(spark: SparkSession, docs: DataFrame, text_col: str, automaton: SuffixAutomaton) -> DataFrame:
    """Adds one block's matches to _ranges and _items."""
    shared = spark.sparkContext.broadcast(automaton)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            names = batch.schema.names
            counts, ranges, items = [], [], []
            before = zip(batch.column("_ranges").to_pylist(), batch.column("_items").to_pylist())
            for text, (old_ranges, old_items) in zip(utf8(batch, text_col), before):
                words = words_of(text)
                hit, found = shared.value.matches(words)
                pairs = list(zip(old_ranges[::2], old_ranges[1::2])) + hit
                counts.append(len(words))
                ranges.append([x for pair in _merged(pairs) for x in pair])
                items.append(sorted({*old_items, *found}))
            fresh = {
                "_words": pa.array(counts, pa.int64()),
                "_ranges": pa.array(ranges, pa.list_(pa.int64())),
                "_items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([fresh.get(n, batch.column(n)) for n in names], names)

    return docs.mapInArrow(scan, docs.schema)


def match_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents with three more columns: _words (long), _ranges (start and end of hit word ranges, in turn), _items.

    A word is a run of letters, digits and non-ASCII characters, A-Z lower case. Hit is a word inside any window of
    consecutive item words that occurs in the document; an item shorter than a window is one window. Items are compared
    by their ids as text, so repeated item rows count once and a NULL id is the empty text. NULL and empty texts have no
    words and no hits; an empty table of items hits nothing. All rows and columns of the documents stay as they are,
    except columns of these three names, which are replaced. One pass over the documents, no shuffle.
    """
    spark = docs.sparkSession
    empty = docs.withColumns(
        {
            "_words": F.lit(0).cast("long"),
            "_ranges": F.array().cast("array<long>"),
            "_items": F.array().cast("array<string>"),
        }
    )
    blocks = item_blocks(items, item_id_col, item_text_col, block_words)
    out = _pass(spark, empty, text_col, SuffixAutomaton(next(blocks, []), window))
    for block in blocks:
        out = _pass(spark, out, text_col, SuffixAutomaton(block, window))
    return out


def hit_counts(matched: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) from the columns that match_items adds."""
    total = F.aggregate(
        F.sequence(F.lit(0), F.size("_ranges") - 1, F.lit(1)),
        F.lit(0).cast("long"),
        lambda s, i: s + F.when(i % 2 == 1, F.get("_ranges", i)).otherwise(-F.get("_ranges", i)),
    )
    hit = F.when(F.size("_ranges") > 0, total).otherwise(F.lit(0).cast("long"))
    return matched.select(
        F.col(id_col),
        F.col("_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.size("_ranges") > 0).alias("contaminated"),
    )


def remove_contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    max_coverage: float = 0.5,
    window: int = WINDOW,
    **item_columns: str,
) -> DataFrame:
    """The documents without hit spans: spans are cut out of the texts, documents hit beyond `max_coverage` go.

    A span reaches from the first byte of its first word to the last byte of its last word. Texts without hits stay as
    they are, NULL too. The columns are those of the documents.
    """

    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            kept, texts = [], []
            before = zip(batch.column("_words").to_pylist(), batch.column("_ranges").to_pylist())
            for raw, text, (count, ranges) in zip(batch.column("_text").to_pylist(), utf8(batch, "_text"), before):
                hit = sum(ranges[1::2]) - sum(ranges[::2])
                kept.append(not ranges or hit <= max_coverage * count)
                if ranges and kept[-1]:
                    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(TABLE))]
                    at, pieces = 0, []
                    for start, end in zip(ranges[::2], ranges[1::2]):
                        pieces.append(text[at : places[start][0]])
                        at = places[end - 1][1]
                    raw = b"".join([*pieces, text[at:]]).decode("utf-8", "replace")
                texts.append(raw)
            columns = zip(names, batch.column("_row").flatten())
            arrays = [pa.array(texts, pa.string()) if n == text_col else column for n, column in columns]
            yield pa.RecordBatch.from_arrays(arrays, names).filter(pa.array(kept, pa.bool_()))

    packed = docs.select(F.struct(*docs.columns).alias("_row"), docs[text_col].alias("_text"))
    matched = match_items(packed, items, "_text", window=window, **item_columns)
    return matched.mapInArrow(cut, docs.schema)


def oracle(docs: str = "documents", items: str = "benchmark", window: int = WINDOW) -> str:
    """The hits in DuckDB SQL: windows of documents joined with windows of items as texts."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, {words} AS w FROM {docs}),
        i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {words} AS w FROM {items}),
        win AS (SELECT DISTINCT item, array_to_string(w[s : s + least({window}, len(w)) - 1], ' ') AS t,
                least({window}, len(w)) AS n
            FROM (SELECT item, w, unnest(range(1, len(w) - least({window}, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM win),
        places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
        hits AS (SELECT r, s, p.n, item FROM (SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS t FROM places) p
            JOIN win ON win.n = p.n AND win.t = p.t),
        pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
        named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN pos USING (r) LEFT JOIN named USING (r)"""
