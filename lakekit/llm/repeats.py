"""Removal of repeated passages: every byte covered by a 100-byte string that stands earlier in the corpus.

All suffixes of a corpus are too many to shuffle. Of each window of 100 bytes one inner position is its anchor: the
leftmost of the smallest hashes of the strings of 24 bytes in it. Equal windows have equal anchors at equal offsets, and
each window belongs to one anchor, so windows can only repeat where anchors do. Anchors of equal surroundings are settled
by an aggregation. The surroundings of the others are suffix-sorted: a mergesort compares suffixes by the longest common
extension, which binary search finds with prefix polynomial hashes, and equal extensions are confirmed byte by byte.
Anchors with very many surroundings are settled by aggregations too, of runs of windows first and of single windows only
in runs that differ and yet share their middle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import shuffles_freed, slices, stored, utf8
from lakekit.llm.near_dups import mixed

LENGTH = 100
GRAM = 24
WIDTH = LENGTH - GRAM + 1  # strings of GRAM bytes in a window
MOST_SORTED = 32  # surroundings of one anchor that are compared by suffix order; windows of more are aggregated by hash
RUN = 8  # windows, by their distance to the anchor, that are aggregated as one before they are singly
BLOCK = 20_000  # surroundings that are sorted at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, 2 * len(_POWERS["up"]))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            _POWERS[name] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base))])
    return _POWERS["up"], _POWERS["down"]


class PrefixHashes:
    """Polynomial hashes modulo 2**64 of all substrings, from one pass over the bytes."""

    def __init__(self, data: np.ndarray) -> None:
        self.up, down = _powers(len(data) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * down[: len(data)], dtype=np.uint64)])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.up[start]

    def every(self, length: int) -> np.ndarray:
        """Hashes of all substrings of one length."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.up[:n]

    def common(self, x: np.ndarray, y: np.ndarray, most: np.ndarray, forward: bool = True) -> np.ndarray:
        """Lengths of the longest common extensions at x and y, at most `most`, by binary search for all pairs at once."""
        low, high = np.zeros(len(x), np.int64), most.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            back = 0 if forward else middle
            same = self.of(x - back, middle) == self.of(y - back, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each run of so many values, by running minima of blocks from both sides."""
    n = len(values)
    size = -(-n // width) * width
    padded = np.full(size, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Anchors:
    """Anchors of a text: key, place, first and last window start, hash of the surroundings; and repeats inside the text.

    With `keys_only` there are only the keys and places.
    """

    def __init__(self, text: bytes, keys_only: bool = False) -> None:
        self.data = np.frombuffer(text, np.uint8)
        n = len(self.data)
        self.windows = max(n - LENGTH + 1, 0)
        empty = np.empty(0, np.int64)
        self.place = self.first = self.last = empty
        self.key = self.around = np.empty(0, np.uint64)
        self.again = np.zeros(self.windows, bool)
        if not self.windows:
            return
        with np.errstate(over="ignore"):
            self.hashes = PrefixHashes(self.data)
            grams = mixed(self.hashes.every(GRAM))
            # The upper half of a hash, then the place: the smallest is the leftmost of the smallest hashes.
            ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
            owner = (_sliding_min(ranked, WIDTH) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            self.first = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])
            self.place = owner[self.first]
            self.key = grams[self.place]
            if keys_only:
                return
            self.last = np.concatenate([self.first[1:] - 1, [self.windows - 1]])
            span = self.last - self.first
            around = self.hashes.of(self.first, span + LENGTH)
            offsets = (self.place - self.first).astype(np.uint64) * np.uint64(1000) + span.astype(np.uint64)
            self.around = mixed(mixed(around) + offsets * np.uint64(0xC2B2AE3D27D4EB4F))
            ordered = np.sort(self.key)
            if (ordered[1:] == ordered[:-1]).any():
                _, inverse, counts = np.unique(self.key, return_inverse=True, return_counts=True)
                self._mark_inner_repeats(np.flatnonzero(counts[inverse] > 1))

    def _mark_inner_repeats(self, owners: np.ndarray) -> None:
        """Marks windows that stand earlier in the text, all under anchors that repeat; hashes are confirmed by bytes."""
        windows = ranges(self.first[owners], self.last[owners])
        _, first, inverse = np.unique(self.hashes.of(windows, LENGTH), return_index=True, return_inverse=True)
        source = windows[first[inverse]]
        later = source < windows
        again, source = windows[later], source[later]
        if not len(again):
            return
        # Runs of windows at one distance from their first occurrence are compared as wholes.
        cuts = np.flatnonzero((np.diff(again) != 1) | (np.diff(source) != 1)) + 1
        begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(again)]])
        text = self.data.tobytes()
        for i, j in zip(begins.tolist(), ends.tolist()):
            x, y, size = int(again[i]), int(source[i]), j - i + LENGTH - 1
            if text[x : x + size] != text[y : y + size]:
                raise ArithmeticError("hash collision inside a text")
        self.again[again] = True


def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers from each first to its last, one range after the other."""
    sizes = last - first + 1
    return np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


def runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of marked places."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2] - 1


def anchors_of(docs: DataFrame) -> DataFrame:
    """(key, around, doc, ref, ends, again) of every anchor that has a window not yet seen in its text; docs: (doc, part, text).

    ref holds the text's part in its upper half and the anchor's place in the lower; ends the distance from the first window
    to the anchor times 128, plus that from the first to the last window. A text with windows that stand earlier in itself has
    one more row whose `again` lists their runs, the first window in the upper half and the last in the lower. Its key is that
    of the first such window, which stands in the text twice at least, so the row is kept with repeated keys. Nothing of a
    text's anchors but the keys has to be found a second time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            keys, arounds, docs_, refs, ends, agains = [], [], [], [], [], []
            for doc, part, text in zip(batch.column("doc").to_pylist(), batch.column("part").to_pylist(), utf8(batch, "text")):
                a = Anchors(text)
                if not a.windows:
                    continue
                fresh = np.add.reduceat(~a.again, a.first) > 0
                keys.append(a.key[fresh])
                arounds.append(a.around[fresh])
                refs.append((part << 32) + a.place[fresh])
                docs_.append(np.full(int(fresh.sum()), doc))
                ends.append(((a.place - a.first) * 128 + a.last - a.first)[fresh])
                agains += [None] * len(ends[-1])
                if a.again.any():
                    first, last = runs(a.again)
                    own = a.key[np.searchsorted(a.first, first[0], "right") - 1]
                    for column, value in ((keys, own), (arounds, 0), (refs, part << 32), (docs_, doc), (ends, 0)):
                        column.append(np.array([value], column[-1].dtype))
                    agains.append((first << 32) + last)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.uint64).view(np.int64)) for x in (keys, arounds)]
                    + [pa.array(np.concatenate(x).astype(np.int64)) for x in (docs_, refs)]
                    + [pa.array(np.concatenate(ends).astype(np.int32)), pa.array(agains, pa.list_(pa.int64()))],
                    ["key", "around", "doc", "ref", "ends", "again"],
                )

    return docs.mapInArrow(run, "key long, around long, doc long, ref long, ends int, again array<long>")


def keys_of(docs: DataFrame) -> DataFrame:
    """The key of every anchor of every text, those of repeats inside the text too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            keys = [Anchors(text, keys_only=True).key for text in utf8(batch, "text") if len(text) >= LENGTH]
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64))], ["key"])

    return docs.select("text").mapInArrow(run, "key long")


def suffix_order(hashes: PrefixHashes, data: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Suffixes sorted by group, then bytes: a mergesort whose comparisons are common extensions.

    All merges of a level run together: every suffix finds its rank in the other half by binary search, with one
    comparison of all suffixes per step.
    """
    n = len(start)
    order = np.argsort(group, kind="stable")
    top = len(data) - 1

    def before(x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix x goes before y; `ties` says so for equal ones."""
        out = group[x] < group[y]
        same = np.flatnonzero(group[x] == group[y])
        if len(same):
            a, b = x[same], y[same]
            most = np.minimum(length[a], length[b])
            common = hashes.common(start[a], start[b], most)
            left, right = data[np.minimum(start[a] + common, top)], data[np.minimum(start[b] + common, top)]
            ended = common == most
            shorter = np.where(length[a] == length[b], ties[same], length[a] < length[b])
            out[same] = np.where(ended, shorter, left < right)
        return out

    width = 1
    while width < n:
        at = np.arange(n)
        run = at // width
        other = (run ^ 1) * width
        low, high = np.zeros(n, np.int64), np.clip(n - other, 0, width)
        first = run % 2 == 0
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            # In the left run equal suffixes stay before those of the right one.
            goes = before(order[other[open_] + middle], order[open_], ~first[open_])
            low[open_] = np.where(goes, middle + 1, low[open_])
            high[open_] = np.where(goes, high[open_], middle)
        new = np.empty_like(order)
        new[(run // 2) * 2 * width + at % width + low] = order
        order = new
        width *= 2
    return order


def settle(group: np.ndarray, document: np.ndarray, left: np.ndarray, around: list[bytes]) -> list[tuple[int, int, int]]:
    """(member, least, most): offsets before its anchor at which windows of the member stand in an earlier document.

    Members of a group share their anchor's string; `document` ranks documents. left: bytes before the anchor.
    """
    data = np.frombuffer(b"".join(around), np.uint8)
    sizes = np.array([len(x) for x in around], np.int64)
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]]) + left
    right = sizes - left
    out = []
    with np.errstate(over="ignore"):
        hashes = PrefixHashes(data)
        order = suffix_order(hashes, data, start, right, group)
        x, y = order[:-1], order[1:]
        near = np.zeros(len(x), np.int64)
        same = np.flatnonzero(group[x] == group[y])
        near[same] = hashes.common(start[x[same]], start[y[same]], np.minimum(right[x[same]], right[y[same]]))
        reach = near.copy()  # common extension of suffixes `step` apart: the smallest between neighbours on the way
        step = 1
        while len(reach):
            p = np.flatnonzero(reach >= GRAM)
            if len(p):
                a, b = order[p], order[p + step]
                back = hashes.common(start[a], start[b], np.minimum(left[a], left[b]), forward=False)
                ok = (document[a] != document[b]) & (back + reach[p] >= LENGTH)
                for i, j, ahead, behind in zip(a[ok].tolist(), b[ok].tolist(), reach[p][ok].tolist(), back[ok].tolist()):
                    later, earlier = (i, j) if document[i] > document[j] else (j, i)
                    s, t = start[later], start[earlier]
                    if not np.array_equal(data[s - behind : s + ahead], data[t - behind : t + ahead]):
                        ahead = _plain(data, s, t, ahead, 1)
                        behind = _plain(data, s - 1, t - 1, behind, -1)
                    if behind + ahead >= LENGTH:
                        out.append((later, max(LENGTH - ahead, 0), min(behind, LENGTH - GRAM)))
            step += 1
            if step > len(near):
                break
            reach = np.minimum(reach[:-1], near[step - 1 :])
            if not (reach >= GRAM).any():
                break
    return out


def _plain(data: np.ndarray, s: int, t: int, most: int, way: int) -> int:
    """A common extension found byte by byte, for hashes that collide."""
    n = 0
    while n < most and data[s + way * n] == data[t + way * n]:
        n += 1
    return n


def _surroundings(wanted: DataFrame, packed: DataFrame) -> DataFrame:
    """(key, doc, part, place, left, many, around): bytes around the wanted anchors, `left` of them before the anchor.

    wanted: (doc, part, key, place, first, last, many).
    """
    lists = wanted.groupBy("doc", "part").agg(F.collect_list(F.struct("place", "key", "first", "last", "many")).alias("list"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, part, z, listed in zip(*(batch.column(c).to_pylist() for c in ("doc", "part", "z", "list"))):
                text = zstandard.decompress(z)
                key, place, first, last = (np.array([w[c] for w in listed], np.int64) for c in ("key", "place", "first", "last"))
                around = [text[x : y + LENGTH] for x, y in zip(first.tolist(), last.tolist())]
                n = len(listed)
                whole = [pa.array(key), pa.array(np.full(n, doc)), pa.array(np.full(n, part)), pa.array(place), pa.array(place - first)]
                many = pa.array([w["many"] for w in listed], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [*whole, many, pa.array(around, pa.binary())], ["key", "doc", "part", "place", "left", "many", "around"]
                )

    schema = "key long, doc long, part long, place long, left long, many boolean, around binary"
    return lists.join(packed.drop("doc_id").dropDuplicates(["doc", "part"]), ["doc", "part"]).mapInArrow(run, schema)


def _runs_of_windows(around: DataFrame) -> DataFrame:
    """(key, run, middle, whole, doc, part, place, first, last): the windows of each anchor, in runs by distance to the anchor.

    `middle` hashes the bytes that all windows of the run have in common, so equal windows have equal middles; `whole` those of
    all windows of this anchor in the run, and which they are.
    """
    names = ["key", "run", "middle", "whole", "doc", "part", "place", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, anchor, left, least = _placed(batch)
            which = ranges(least // RUN, left // RUN)
            of = np.repeat(np.arange(len(left)), left // RUN - least // RUN + 1)
            near, far = np.maximum(least[of], which * RUN), np.minimum(left[of], which * RUN + RUN - 1)
            with np.errstate(over="ignore"):
                middle = mixed(hashes.of(anchor[of] - which * RUN, LENGTH + 1 - RUN) + np.uint64(1))
                whole = mixed(hashes.of(anchor[of] - far, far - near + LENGTH) + np.uint64(1))
                whole = mixed(whole + (far * 128 + near).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
            key, doc, part, place = (batch.column(c).to_numpy()[of] for c in ("key", "doc", "part", "place"))
            columns = [key, which, middle.view(np.int64), whole.view(np.int64), doc, part, place, place - far, place - near]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return around.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def _windows(around: DataFrame) -> DataFrame:
    """(key, window, doc, part, place): hashes of the windows whose run's bit is set in `open`, and where they begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, anchor, left, least = _placed(batch)
            before, of = ranges(least, left), np.repeat(np.arange(len(left)), left - least + 1)
            wanted = (batch.column("open").to_numpy()[of] >> (before // RUN)) & 1 > 0
            before, of = before[wanted], of[wanted]
            with np.errstate(over="ignore"):
                window = mixed(hashes.of(anchor[of] - before, LENGTH) + np.uint64(1))
            key, doc, part, place = (batch.column(c).to_numpy()[of] for c in ("key", "doc", "part", "place"))
            columns = [key, window.view(np.int64), doc, part, place - before]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "window", "doc", "part", "place"])

    return around.mapInArrow(run, "key long, window long, doc long, part long, place long")


def _placed(batch: pa.RecordBatch) -> tuple[PrefixHashes, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the joined surroundings; the anchors' places in them; most and least bytes of a window before its anchor."""
    around = batch.column("around").to_pylist()
    sizes, left = np.array([len(x) for x in around], np.int64), batch.column("left").to_numpy()
    with np.errstate(over="ignore"):
        hashes = PrefixHashes(np.frombuffer(b"".join(around), np.uint8))
    return hashes, np.cumsum(sizes) - sizes + left, left, left - (sizes - LENGTH)


def _by_hash(around: DataFrame) -> DataFrame:
    """(doc, part, first, last): windows that stand in earlier documents, for anchors with many surroundings.

    Runs that stand earlier as a whole are covered. Single windows are compared only in the first occurrences of runs whose
    middle stands in other runs too, so an anchor has a few rows at either step.
    """
    parts = _runs_of_windows(around)
    own = F.struct("doc", "part") == F.col("owner")
    firsts = parts.groupBy("key", "run", "middle", "whole").agg(F.min(F.struct("doc", "part")).alias("owner"))
    kinds = firsts.groupBy("key", "run", "middle").agg(F.count("*").alias("kinds"))
    owned = firsts.join(kinds, ["key", "run", "middle"])
    judged = stored(
        parts.join(owned, ["key", "run", "middle", "whole"])
        .where(~own | (F.col("kinds") > 1))
        .select("doc", "part", "first", "last", *[F.when(own, F.col(c)).alias(c) for c in ("key", "place", "run")]),
        "repeat-runs",
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("run").cast("int"))
    open_ = judged.where("run IS NOT NULL").groupBy("key", "doc", "part", "place").agg(F.bit_or(bit).alias("open"))
    windows = _windows(around.join(open_, ["key", "doc", "part", "place"]))
    earliest = windows.groupBy("key", "window").agg(F.min(F.struct("doc", "part")).alias("owner"))
    single = windows.join(earliest, ["key", "window"]).where(~own)
    single = stored(single.select("doc", "part", F.col("place").alias("first"), F.col("place").alias("last")), "repeat-windows")
    return judged.where("run IS NULL").select("doc", "part", "first", "last").unionByName(single)


def _settled(members: DataFrame) -> DataFrame:
    """(doc, part, first, last): windows of the members that stand in earlier documents; rows of a key stand together."""

    def block(rows: list[tuple]) -> pa.RecordBatch:
        keys = np.array([r[0] for r in rows])
        group = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))
        texts = [(r[1], r[2]) for r in rows]
        rank = {t: i for i, t in enumerate(sorted(set(texts)))}
        found = settle(group, np.array([rank[t] for t in texts]), np.array([r[4] for r in rows]), [r[5] for r in rows])
        out = [(rows[i][1], rows[i][2], rows[i][3] - most, rows[i][3] - least) for i, least, most in found]
        columns = zip(*out) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "part", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc", "part", "place", "left", "around"))):
                if len(held) >= BLOCK and held[-1][0] != row[0]:
                    yield block(held)
                    held = []
                held.append(row)
        if held:
            yield block(held)

    return members.mapInArrow(run, "doc long, part long, first long, last long")


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, part, text) to the same with compressed texts z, for shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches, "text"):
            z = pa.array([squeeze.compress(t) for t in utf8(batch, "text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "doc", "part")), z], ["doc_id", "doc", "part", "z"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {key}, doc long, part long, z binary")


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, doc, part, text): doc orders documents, NULL last; part tells texts of the same id apart."""
    key = docs[id_col]
    last = F.lit((1 << 63) - 1)
    part = F.shiftrightunsigned(F.xxhash64(docs[text_col]), 33)
    return docs.select(key.alias("doc_id"), F.coalesce(key.cast("long"), last).alias("doc"), part.alias("part"), docs[text_col].alias("text"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of the documents.

    A byte is removed if a string of 100 bytes that covers it also starts earlier: in a document of a smaller id, or
    before in the same document. Strings are judged on the input, never across documents. Ids are integers; NULL is larger
    than all. Rows with the same id and text are one document and get equal results; different texts of one id are
    ordered by a hash. NULL and empty texts have no bytes. An empty table gives no rows. Other columns don't matter.
    `kept` is what remains, as bytes, since cuts may fall inside characters.

    Windows are compared by 128 bits of hash where anchors and surroundings agree, and byte by byte elsewhere, but for
    anchors with more than MOST_SORTED different surroundings, whose windows are compared by hash alone.
    """
    source = _documents(docs, id_col, text_col)
    packed = packed_texts(source)
    with shuffles_freed(docs.sparkSession):
        lists = stored(_marked(source, packed), "repeat-marks")
    key = source.schema["doc_id"].dataType.simpleString()
    return packed.join(lists, ["doc", "part"], "left").mapInArrow(
        _cut, f"doc_id {key}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def _marked(source: DataFrame, packed: DataFrame) -> DataFrame:
    """(doc, part, list) of every text with windows that stand earlier: their runs, as (first, last).

    Every step is stored, so that no more than one step's shuffles are on disk at a time.
    """
    anchors = anchors_of(source.select("doc", "part", "text"))
    repeated = keys_of(source).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    hits = stored(anchors.join(repeated, "key"), "repeat-hits")
    part, place = F.shiftright("ref", 32), F.col("ref").bitwiseAND((1 << 32) - 1)
    start = place - F.floor(F.col("ends") / 128)
    named = hits.where("again IS NULL").select(
        "key",
        "around",
        "doc",
        part.alias("part"),
        place.alias("place"),
        start.alias("first"),
        (start + F.col("ends") % 128).alias("last"),
    )
    run = F.explode("again").alias("run")
    inner = hits.where("again IS NOT NULL").select("doc", part.alias("part"), run).select(
        "doc", "part", F.shiftright("run", 32).alias("first"), F.col("run").bitwiseAND((1 << 32) - 1).alias("last")
    )
    firsts = named.groupBy("key", "around").agg(F.min(F.struct("doc", "part")).alias("owner"))
    kinds = firsts.groupBy("key").agg(F.count("*").alias("kinds"))
    owned = firsts.join(kinds, "key")
    own = F.struct("doc", "part") == F.col("owner")
    judged = stored(
        named.join(owned, ["key", "around"])
        .where(~own | (F.col("kinds") > 1))
        .select(
            "doc",
            "part",
            "first",
            "last",
            *[F.when(own, F.col(c)).alias(c) for c in ("key", "place")],
            F.when(own, F.col("kinds") > MOST_SORTED).alias("many"),
        ),
        "repeat-judged",
    )
    covers = judged.where("many IS NULL").select("doc", "part", "first", "last")
    around = stored(_surroundings(judged.where("many IS NOT NULL"), packed), "repeat-surroundings")
    members = around.where("NOT many").repartition("key").sortWithinPartitions("key", "doc", "part", "place")
    marks = covers.unionByName(inner).unionByName(_settled(members)).unionByName(_by_hash(around.where("many"))).distinct()
    return marks.groupBy("doc", "part").agg(F.collect_list(F.struct("first", "last")).alias("list"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes the bytes of marked windows."""
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for batch in slices(batches, "z", 1 << 20):
        rows = []
        for z, marks in zip(batch.column("z").to_pylist(), batch.column("list").to_pylist()):
            text = zstandard.decompress(z)
            if not marks:
                rows.append((len(text), 0, 0, hashlib.sha256(text).hexdigest(), text))
                continue
            change = np.zeros(len(text) + 1, np.int64)
            first, last = (np.array([m[c] for m in marks], np.int64) for c in ("first", "last"))
            np.add.at(change, first, 1)
            np.add.at(change, last + LENGTH, -1)
            gone = np.cumsum(change[:-1]) > 0
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
            rows.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])


def bytes_kept() -> Column:
    """What remains as text; bytes of cut characters are replaced."""
    return F.decode("kept", "UTF-8")
