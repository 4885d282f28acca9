"""Scoring texts by a log-bilinear neural language model, trained in numpy by noise-contrastive estimation.

The model predicts the next token: a token with vectors of its own, the end, or a group of the other tokens with alike
endings. All tokens counted often enough have vectors of their own. Context tokens' vectors, scaled by position, add up to
a predicted vector. Its products with all classes' vectors, normalised, are the classes' probabilities; its products with
the vectors of one class's tokens, normalised, are theirs within the class. Classes are ranges of tokens by frequency.
Within a group, tokens have smoothed relative frequencies, so that the probabilities of all known tokens and one unknown
in each group add up to one. Counts and training cover all training documents, and every position is an example once:
counts by a shuffle, training by tasks that each learn from their part and whose parameters are averaged.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import slices, stored, utf8
from lakekit.llm.quality import remainder

END = b""  # the token that ends every text; no word is empty
GROUPS = 64  # for tokens that have no vectors of their own
OWN_COUNT = 50  # of the training texts, from which a token has vectors of its own if it is a frequent one
DIMENSIONS = 16
CONTEXT = 5
NOISE = 64  # noise classes that the examples of a batch share
NOISE_RATIO = 8.0
RIVALS = 4  # noise tokens of its class for each example
RATE = 0.1
BATCH = 1024
RUN = 16  # positions of a text that come into a batch together
ROUNDS = 2  # each takes half of the training texts, whole
TRAINING_TASKS = 64  # at most; each ends with the rows of the model that it has changed
PARTS_SHARE = 0.5  # of the training texts' bytes: all that the tasks of all rounds end with is no more, if several train
BLOCK = 1024  # rows of the model that are averaged together
FREQUENT = 300_000  # at most so many tokens with their counts are sent to every task; the others are joined
FLUSH = 400_000
SCORED = 1 << 18  # positions that are scored together
SAFE = 60.0  # thousands of exponentials of such numbers, or of their negatives, add up within the range of 32 bits


def tokens_of(text: bytes) -> list[bytes]:
    """Blank-separated words, A-Z in lower case, and the end."""
    words = text.lower().split()
    words.append(END)
    return words


@dataclass(frozen=True)
class LogBilinear:
    """Vectors of context tokens by id, scales by context position, vectors and biases of classes and of predicted tokens.

    Predicted tokens are in the order of their classes: `place` has theirs by id, `starts` the classes' first places.
    """

    contexts: np.ndarray
    scales: np.ndarray
    class_targets: np.ndarray
    class_biases: np.ndarray
    targets: np.ndarray
    biases: np.ndarray
    noise: np.ndarray
    place: np.ndarray
    starts: np.ndarray

    def copy(self) -> LogBilinear:
        """Parameters of its own, of numpy's own 32-bit type: pickled arrays come back with a type object that is equal to
        it but not the same, and with such arrays ufunc.at takes a path that is many times slower."""
        return replace(self, **{name: getattr(self, name).astype(np.dtype("float32")) for name in PARAMETERS})

    def predicted(self, history: np.ndarray) -> np.ndarray:
        out = np.empty((len(history), self.scales.shape[1]), np.float32)
        for a in range(0, len(history), 2048):  # what the processor's cache holds
            out[a : a + 2048] = np.einsum("nkd,kd->nd", self.contexts.take(history[a : a + 2048], axis=0), self.scales)
        return out

    def layers(self) -> tuple[_Softmax, _Softmax]:
        """Of the classes and of the tokens inside them."""
        return _Softmax.of(self.class_targets, self.class_biases), _Softmax.of(self.targets, self.biases)

    def log_probabilities(self, history: np.ndarray, following: np.ndarray) -> np.ndarray:
        """Natural logarithms of the normalised probabilities of `following` after `history`."""
        return self._logs(self.predicted(history), following, self.layers())

    def text_log_probabilities(self, texts: list[np.ndarray], layers: tuple[_Softmax, _Softmax]) -> np.ndarray:
        """Those of all positions of the texts, one text after the other."""
        context = len(self.scales)
        stream, known = _stream(texts, context)
        vectors = np.zeros((len(stream), self.scales.shape[1]), np.float32)
        for a in range(context, len(stream), 2048):
            before = self.contexts.take(stream[a - context : a + 2047], axis=0)
            own = vectors[a : a + 2048]
            for k in range(context):
                own += before[context - 1 - k : context - 1 - k + len(own)] * self.scales[k]
        return self._logs(vectors[known], stream[known], layers)

    def _logs(self, predicted: np.ndarray, following: np.ndarray, layers: tuple[_Softmax, _Softmax]) -> np.ndarray:
        classes, tokens = layers
        out = np.empty(len(following))
        for a in range(0, len(following), SCORED):
            vectors = predicted[a : a + SCORED]
            place = self.place.take(following[a : a + SCORED])
            order = np.argsort(place)
            place = place[order]
            longest = math.sqrt(np.einsum("nd,nd->n", vectors, vectors).max())
            vectors = np.hstack([vectors[order], np.ones((len(order), 1), np.float32)])
            edges = np.searchsorted(place, self.starts)
            total = np.empty(len(place))
            kind = np.repeat(np.arange(len(self.starts) - 1), np.diff(edges))
            for i in range(0, len(place), 512):
                total[i : i + 512] = classes.logs(vectors[i : i + 512], longest, kind[i : i + 512], 0, len(self.starts) - 1)
            for c in np.flatnonzero((np.diff(edges) > 0) & (np.diff(self.starts) > 1)):
                low, high = self.starts[c], self.starts[c + 1]
                step = max(1, (1 << 18) // (high - low))
                for i in range(edges[c], edges[c + 1], step):
                    j = min(i + step, edges[c + 1])
                    total[i:j] += tokens.logs(vectors[i:j], longest, place[i:j], low, high)
            out[a + order] = total
        return out


PARAMETERS = ("contexts", "scales", "class_targets", "class_biases", "targets", "biases")


@dataclass(frozen=True)
class _Softmax:
    """Vectors with their biases as a last component."""

    columns: np.ndarray
    longest: float
    highest: float

    @classmethod
    def of(cls, targets: np.ndarray, biases: np.ndarray) -> _Softmax:
        longest = math.sqrt(np.einsum("nd,nd->n", targets, targets).max())
        columns = np.ascontiguousarray(np.hstack([targets, biases[:, None]]).T)
        return cls(columns, longest, float(np.abs(biases).max()))

    def logs(self, vectors: np.ndarray, longest: float, chosen: np.ndarray, low: int, high: int) -> np.ndarray:
        """Log probabilities of the chosen ones among those from `low` to `high`, one for each vector, whose last component
        is 1; no vector's length, without it, is above `longest`."""
        logits = vectors @ self.columns[:, low:high]
        own = logits[np.arange(len(chosen)), chosen - low]
        if longest * self.longest + self.highest > SAFE:
            peak = logits.max(axis=1)
            logits -= peak[:, None]
            own = own - peak
        np.exp(logits, out=logits)
        return own - np.log(logits @ np.ones(high - low, np.float32))


def initial(token_counts: np.ndarray, dimensions: int = DIMENSIONS, context: int = CONTEXT, seed: int = 11) -> LogBilinear:
    """The model that predicts the relative frequencies of the tokens in any context.

    Classes are about as many as the root of the tokens, of like sums of roots of counts: common tokens are in small ones.
    """
    rng = np.random.default_rng(seed)
    counts = np.asarray(token_counts, float) + 1
    n = len(counts)
    order = np.argsort(-counts, kind="stable")
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    counts = counts[order]
    mass = np.cumsum(np.sqrt(counts))
    label = np.floor((mass - np.sqrt(counts)) / mass[-1] * np.ceil(np.sqrt(n)))
    starts = np.concatenate([[0], np.flatnonzero(np.diff(label)) + 1, [n]]).astype(np.int32)
    in_class = np.add.reduceat(counts, starts[:-1])
    share = in_class / in_class.sum()
    return LogBilinear(
        rng.normal(0, 0.3, (n, dimensions)).astype(np.float32),
        np.tile(np.float32(1.0 / context), (context, dimensions)),
        rng.normal(0, 0.1, (len(share), dimensions)).astype(np.float32),
        np.log(share).astype(np.float32),
        rng.normal(0, 0.1, (n, dimensions)).astype(np.float32),
        np.log(counts / np.repeat(in_class, np.diff(starts))).astype(np.float32),
        share,
        place,
        starts,
    )


class Trainer:
    """Noise-contrastive estimation: tells the real next class from classes drawn by frequency, and the real next token from
    others of its class, drawn evenly. Adagrad, batches of numpy.

    Tokens' rows have one Adagrad sum each, of the mean squares of all gradients that reach the row: a batch is scattered
    to the tables as it is, without bringing together the gradients of equal tokens first.
    """

    def __init__(self, model: LogBilinear, seed: int) -> None:
        self.model = model.copy()
        self.sums = {name: np.full(getattr(model, name).shape, 1e-1, np.float32) for name in _DENSE}
        self.sums |= {name: np.full(len(model.place), 1e-1, np.float32) for name in ("contexts", "targets")}
        self.rng = np.random.default_rng(seed)
        self.noise_edges = np.cumsum(model.noise)
        self.log_noise = np.log(model.noise * NOISE_RATIO).astype(np.float32)
        self.class_of = np.repeat(np.arange(len(model.noise), dtype=np.int32), np.diff(model.starts))
        self.sizes = np.diff(model.starts).astype(np.float32)
        self.log_odds = np.log(RIVALS / self.sizes)
        self.seen = {name: np.zeros(len(model.place), np.float32) for name in ("contexts", "targets")}

    def _move(self, name: str, grad: np.ndarray) -> None:
        sums = self.sums[name]
        sums += grad * grad
        getattr(self.model, name)[...] -= RATE * grad / np.sqrt(sums)

    def _rates(self, name: str, rows: np.ndarray, squares: np.ndarray) -> np.ndarray:
        """Step lengths of the rows after their mean squares have been added."""
        sums = self.sums[name]
        np.add.at(sums, rows, squares.ravel())
        return (np.float32(RATE) / np.sqrt(sums.take(rows))).reshape(squares.shape)

    def step(self, history: np.ndarray, following: np.ndarray) -> None:
        """One batch of any examples."""
        m = self.model
        before = m.contexts.take(history, axis=0)
        d_vectors = self._predict(np.einsum("nkd,kd->nd", before, m.scales), following)
        g_scales = np.einsum("nd,nkd->kd", d_vectors, before)
        grad = np.einsum("nd,kd->nkd", d_vectors, m.scales).reshape(-1, before.shape[2])
        self._move_contexts(history.ravel(), grad, g_scales)

    def step_runs(self, runs: np.ndarray, known: np.ndarray) -> None:
        """One batch of the positions of runs of tokens, except the first ones that are only contexts, and those not `known`.

        Positions share contexts, so each of a run's tokens is looked up and moved once.
        """
        m = self.model
        context, n = len(m.scales), runs.shape[1] - len(m.scales)
        before = m.contexts.take(runs, axis=0)
        places = np.arange(n)
        bands = np.zeros((before.shape[2], context + n, n), np.float32)  # by dimension: the scale of a place for a position
        for k in range(context):
            bands[:, places + context - 1 - k, places] = m.scales[k][:, None]
        by_dimension = np.ascontiguousarray(before.transpose(2, 0, 1))
        vectors = np.ascontiguousarray((by_dimension @ bands).transpose(1, 2, 0))
        d_vectors, following = np.zeros_like(vectors), runs[:, context:]
        if known.all():
            d_vectors.reshape(-1, vectors.shape[2])[:] = self._predict(vectors.reshape(-1, vectors.shape[2]), following.ravel())
        else:
            d_vectors[known] = self._predict(vectors[known], following[known])
        back = np.ascontiguousarray(d_vectors.transpose(2, 0, 1))
        grad = np.ascontiguousarray((back @ bands.transpose(0, 2, 1)).transpose(1, 2, 0))
        products = by_dimension.transpose(0, 2, 1) @ back
        g_scales = np.stack([products[:, places + context - 1 - k, places].sum(axis=1) for k in range(context)])
        self._move_contexts(runs.ravel(), grad.reshape(-1, grad.shape[2]), g_scales)

    def _move_contexts(self, rows: np.ndarray, grad: np.ndarray, g_scales: np.ndarray) -> None:
        grad *= self._rates("contexts", rows, np.einsum("nd,nd->n", grad, grad) / np.float32(grad.shape[1]))[:, None]
        _scatter(np.subtract, self.model.contexts, rows, grad)
        np.add.at(self.seen["contexts"], rows, np.float32(1))
        self._move("scales", g_scales)

    def _predict(self, vectors: np.ndarray, following: np.ndarray) -> np.ndarray:
        """Learns to predict `following` by the vectors; returns these vectors' gradients."""
        m, d = self.model, vectors.shape[1]
        place = m.place.take(following)
        kind = self.class_of.take(place)
        drawn = np.searchsorted(self.noise_edges[:-1], self.rng.random(NOISE) * self.noise_edges[-1], "right")
        real_class, drawn_class = m.class_targets.take(kind, axis=0), m.class_targets[drawn]
        bias = m.class_biases - self.log_noise
        d_real = _sigmoid(np.einsum("ij,ij->i", vectors, real_class) + bias.take(kind)) - 1
        d_fake = _sigmoid(vectors @ drawn_class.T + bias[drawn])
        d_fake *= np.float32(NOISE_RATIO / NOISE)
        d_vectors = d_real[:, None] * real_class + d_fake @ drawn_class
        g_classes, g_class_biases = np.zeros_like(m.class_targets), np.zeros_like(m.class_biases)
        _scatter(np.add, g_classes, kind, d_real[:, None] * vectors)
        np.add.at(g_class_biases, kind, d_real)
        _scatter(np.add, g_classes, drawn, d_fake.T @ vectors)
        np.add.at(g_class_biases, drawn, d_fake.sum(axis=0))

        size = self.sizes.take(kind)
        offset = (self.rng.random((len(place), RIVALS), np.float32) * size[:, None]).astype(np.int32)
        words = np.empty((len(place), 1 + RIVALS), np.int32)
        words[:, 0] = place
        words[:, 1:] = m.starts.take(kind)[:, None] + np.minimum(offset, size.astype(np.int32)[:, None] - 1)
        rows = words.ravel()
        own = m.targets.take(words, axis=0)
        d_words = _sigmoid(np.einsum("nrd,nd->nr", own, vectors) + m.biases.take(words) - self.log_odds.take(kind)[:, None])
        d_words[:, 0] -= 1
        d_words *= (size > 1)[:, None]  # a class of one token has nothing to tell apart
        d_vectors += np.einsum("nr,nrd->nd", d_words, own)
        squares = d_words * d_words * ((np.einsum("nd,nd->n", vectors, vectors) + 1) / (d + 1))[:, None]
        moves = d_words * self._rates("targets", rows, squares)
        _scatter(np.subtract, m.targets, rows, np.einsum("nr,nd->nrd", moves, vectors))
        np.subtract.at(m.biases, rows, moves.ravel())
        np.add.at(self.seen["targets"], rows, np.float32(1))
        self._move("class_targets", g_classes)
        self._move("class_biases", g_class_biases)
        return d_vectors


def _scatter(combine: np.ufunc, total: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Adds to, or takes from, each given row of the total a row of the values; flat, where numpy is fast, and, for the
    same sums with half as many places, with two numbers as one complex number."""
    d = total.shape[1]
    if d % 2 == 0:
        pair = np.dtype("complex64")
        total, values, d = total.view(pair), np.ascontiguousarray(values).view(pair), d // 2
    places = rows.astype(np.int64)[:, None] * d + np.arange(d)
    combine.at(total.reshape(-1), places.ravel(), values.ravel())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """Overwrites the numbers."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def examples(texts: list[np.ndarray], context: int) -> tuple[np.ndarray, np.ndarray]:
    """(histories, following tokens) of every position of each text; before a text there are ends."""
    stream, known = _stream(texts, context)
    places = np.flatnonzero(known)
    return stream[places[:, None] - np.arange(1, context + 1)], stream[places]


def _stream(texts: list[np.ndarray], context: int) -> tuple[np.ndarray, np.ndarray]:
    """(the texts one after the other, with ends before each; whether a token is of a text)."""
    before = np.full(context, GROUPS, np.int32)
    stream = np.concatenate([x for ids in texts for x in (before, ids)])
    known = np.ones(len(stream), bool)
    starts = np.cumsum([0] + [context + len(ids) for ids in texts[:-1]])
    known[(starts[:, None] + np.arange(context)).ravel()] = False
    return stream, known


def runs_of(texts: list[np.ndarray], context: int, length: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """The texts as runs of so many positions after as many contexts as the model has; which of the positions are examples."""
    stream, known = _stream(texts, context)
    n = -(-len(stream) // length)
    stream = np.concatenate([np.full(context, GROUPS, np.int32), stream, np.full(n * length - len(stream), GROUPS, np.int32)])
    known = np.concatenate([known, np.zeros(n * length - len(known), bool)]).reshape(n, length)
    return np.lib.stride_tricks.sliding_window_view(stream, context + length)[::length], known


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c) over all documents of (text): tasks add up what they read before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["token", "c"]
            )

        for batch in slices(batches, "text"):
            for text in utf8(batch, "text"):
                held.update(tokens_of(text))
            if len(held) > FLUSH:
                yield flushed()
                held.clear()
        if held:
            yield flushed()

    return docs.select("text").mapInArrow(run, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


def frequent_tokens(counts: DataFrame, most: int) -> tuple[dict[bytes, int], int]:
    """(the tokens with at least a certain count, at most `most` of them; that count), by a histogram of counts."""
    level = F.floor(F.log2("c") * 16)
    bins = sorted(((r["level"], r["n"], r["low"]) for r in counts.groupBy(level.alias("level")).agg(
        F.count("*").alias("n"), F.min("c").alias("low")).collect()), reverse=True)
    least, total = None, 0
    for _, n, low in bins:
        total += n
        if total > most:
            break
        least = low
    if least is None:
        return {}, (bins[0][2] + 1 if bins else 1)
    rows = counts.where(F.col("c") >= least).toArrow()
    return dict(zip((t.encode() for t in rows["token"].to_pylist()), rows["c"].to_pylist())), least


class TokenTable(dict):
    """Id by token: the end, then tokens with vectors of their own; all others by the hash of their last two bytes."""

    def __missing__(self, token: bytes) -> int:
        return zlib.crc32(token[-2:]) % GROUPS

    @classmethod
    def of(cls, frequent: dict[bytes, int], least: int) -> TokenTable:
        words = sorted((t for t, c in frequent.items() if t != END and c >= least), key=lambda t: (-frequent[t], t))
        return cls({END: GROUPS} | {t: GROUPS + 1 + i for i, t in enumerate(words)})


def group_masses(counts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts, distinct tokens) of each group of tokens counted less than `least` times, over all counted tokens."""
    group = F.crc32(F.substring(F.col("token").cast("binary"), -2, 2)) % GROUPS
    others = counts.where((F.col("c") < least) & (F.col("token") != END.decode()))
    rows = others.groupBy(group.alias("g")).agg(F.sum("c").alias("c"), F.count("*").alias("v"))
    total, distinct = np.zeros(GROUPS), np.zeros(GROUPS)
    for r in rows.collect():
        total[r["g"]], distinct[r["g"]] = r["c"], r["v"]
    return total, distinct


# Parameters that have a row per token, and those that every example moves.
_BY_TOKEN = {"contexts": ("contexts",), "targets": ("targets", "biases")}
_DENSE = ("scales", "class_targets", "class_biases")
_PART = "part string, block int, task int, rows binary, weights binary, flat binary"


def _table(model: LogBilinear, part: str, rows=slice(None)) -> np.ndarray:
    """A part of the model as a matrix: the rows of tokens, or all that every example moves as one row."""
    if part == "dense":
        return np.concatenate([getattr(model, x).ravel() for x in _DENSE])[None]
    return np.hstack([getattr(model, x)[rows].reshape(-1, model.contexts.shape[1] if x != "biases" else 1) for x in _BY_TOKEN[part]])


def _parts(trainer: Trainer, task: int, n: int) -> Iterator[pa.RecordBatch]:
    """What a task has changed, by blocks of rows; a row's weight is how often the task has seen it."""
    names = [c.split()[0] for c in _PART.split(", ")]
    found = [("dense", 0, np.zeros(1, np.int32), np.array([n], np.float32))]
    for part in _BY_TOKEN:
        rows = np.flatnonzero(trainer.seen[part]).astype(np.int32)
        for own in np.split(rows, np.flatnonzero(np.diff(rows // BLOCK)) + 1) if len(rows) else []:
            found.append((part, int(own[0]) // BLOCK, own, trainer.seen[part][own]))
    for part, block, rows, weights in found:
        values = [part], [block], [task], [rows.tobytes()], [weights.tobytes()], [_table(trainer.model, part, rows).tobytes()]
        kinds = pa.string(), pa.int32(), pa.int32(), *[pa.binary()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)


def _averaged(table: pa.Table) -> pa.Table:
    """The mean of one block over the tasks that have seen its rows, by how often they have."""
    table = table.sort_by("task")
    total, weight = None, np.zeros(BLOCK)
    for rows, weights, flat in zip(*(table[c].to_pylist() for c in ("rows", "weights", "flat"))):
        own, weights = np.frombuffer(rows, np.int32) % BLOCK, np.frombuffer(weights, np.float32)
        values = np.frombuffer(flat, np.float32).reshape(len(own), -1)
        if total is None:
            total = np.zeros((BLOCK if table["part"][0].as_py() != "dense" else 1, values.shape[1]))
        total[own] += values * weights[:, None].astype(float)
        weight[own] += weights
    own = np.flatnonzero(weight).astype(np.int32)
    rows = own + np.int32(table["block"][0].as_py() * BLOCK)
    mean = (total[own] / weight[own, None]).astype(np.float32)
    done = table.slice(0, 1).drop_columns(["rows", "weights", "flat"])
    for name, value in (("rows", rows), ("weights", weight[own].astype(np.float32)), ("flat", mean)):
        done = done.append_column(name, pa.array([value.tobytes()], pa.binary()))
    return done


def training_tasks(text_bytes: int, rows: int, rounds: int = ROUNDS) -> int:
    """How many tasks train at a time: so few that their parts, which Spark averages, stay small beside the texts."""
    part = rows * (2 * DIMENSIONS + 1 + 2 * 2) * 4  # two vectors, a bias, two row numbers and two weights
    return int(min(TRAINING_TASKS, max(1, PARTS_SHARE * text_bytes // (part * rounds))))


def train(docs: DataFrame, table: TokenTable, counts: np.ndarray, tasks: int, rounds: int = ROUNDS) -> LogBilinear:
    """Rounds of training on all documents of (doc_id, text): every task starts from the last model, and the results are averaged.

    A task takes its texts in order and ends with the rows it has changed; blocks of rows are averaged by Spark, so
    that the driver gets one model per round. Of n rounds, each takes the texts of one remainder of the hash of their ids,
    so that all rounds together take every position of every text once.
    """
    spark = docs.sparkSession
    model = initial(counts)
    shared_table = spark.sparkContext.broadcast(table)
    turn_of = F.pmod(F.xxhash64("doc_id"), F.lit(rounds))
    for turn in range(rounds):
        start = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get().partitionId()
            trainer, n = Trainer(start.value, 1000 * turn + task), 0
            for batch in slices(batches, "text", 1 << 20):
                texts = [_ids(tokens_of(t), shared_table.value) for t in utf8(batch, "text")]
                runs, known = runs_of(texts, CONTEXT)
                order = trainer.rng.permutation(len(runs))
                for a in range(0, len(order), BATCH // RUN):
                    chosen = order[a : a + BATCH // RUN]
                    trainer.step_runs(runs[chosen], known[chosen])
                n += int(known.sum())
            if n:
                yield from _parts(trainer, task, n)

        dealt = docs.where(turn_of == turn).select("text").coalesce(tasks)
        found = dealt.mapInArrow(run, _PART).groupBy("part", "block").applyInArrow(_averaged, _PART).toArrow()
        model = model.copy()
        for part, rows, flat in zip(*(found[c].to_pylist() for c in ("part", "rows", "flat"))):
            rows, at = np.frombuffer(rows, np.int32), 0
            values = np.frombuffer(flat, np.float32).reshape(len(rows), -1)
            for name in _DENSE if part == "dense" else _BY_TOKEN[part]:
                x = getattr(model, name)
                if part == "dense":
                    x[:] = values[0, at : at + x.size].reshape(x.shape)
                    at += x.size
                else:
                    width = x[:1].size
                    x[rows] = values[:, at : at + width].reshape(len(rows), *x.shape[1:])
                    at += width
        start.unpersist()
    return model


def _ids(tokens: list[bytes], table: TokenTable) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, tokens), np.int32, len(tokens))


@dataclass(frozen=True)
class Scorer:
    model: LogBilinear
    table: TokenTable
    frequent: dict[bytes, int]
    counts: np.ndarray  # of the tokens with vectors of their own by id, zeros before them
    log_masses: np.ndarray  # of the groups, zeros after them

    @cached_property
    def _layers(self) -> tuple[_Softmax, _Softmax]:
        return self.model.layers()

    def heads(self, texts: list[list[bytes]]) -> tuple[list[tuple], list[Counter]]:
        """Per text: (tokens, frequent ones, base sum, model sum), and counts of tokens that aren't frequent."""
        ids = [_ids(t, self.table) for t in texts]
        logs = self.model.text_log_probabilities(ids, self._layers) / math.log(10)
        ends = np.cumsum([len(x) for x in ids])
        heads, rare = [], []
        for tokens, own, end in zip(texts, ids, ends):
            counts = self.counts.take(own)
            grouped = np.flatnonzero(own < GROUPS)
            counts[grouped] = [self.frequent.get(tokens[i], 0) for i in grouped.tolist()]
            known = np.log10(counts + 1)
            inside = known[grouped].sum() - self.log_masses.take(own[grouped]).sum()
            model = float(logs[end - len(own) : end].sum() + inside)
            unknown = np.flatnonzero(counts == 0).tolist()
            heads.append((len(tokens), len(tokens) - len(unknown), float(known.sum()), model))
            rare.append(Counter([tokens[i] for i in unknown]))
        return heads, rare


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 7,
    held_out: int = 2,
    frequent_limit: int = FREQUENT,
    own_count: int = OWN_COUNT,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of the documents.

    Learns from rows whose crc32(id as text) mod `folds` isn't `held_out`. Tokens are words and one end per text. The base
    score adds log10((c + 1) / (N + V + 1)) with the token's count c, all N and the V distinct training tokens; the score
    is the model's. NULL and empty texts have one token, the end. Rows of the same id are scored one by one. Without
    training rows all counts are 0. An empty table gives no rows. Other columns don't matter.

    Frequent tokens' counts, bounded in number, go to every task; all others are looked up by a join on the token, with
    one row per document and token, so no count is left out and no vocabulary has to fit anywhere.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), docs[text_col].alias("text")
    )
    rest = remainder(F.col("doc_id"), folds)
    training = texts.where(rest != held_out)
    counts = stored(token_counts(training), "lm-counts")
    size = F.sum(F.col("c") * (F.octet_length("token") + 1))
    totals = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(size, F.lit(0)).alias("bytes")
    ).first()
    frequent, least = frequent_tokens(counts, frequent_limit)
    own_least = max(least, own_count)
    table = TokenTable.of(frequent, own_least)
    in_groups, distinct = group_masses(counts, own_least)
    by_token = np.concatenate([in_groups, [frequent.get(t, 0) for t in table]])
    own_counts = by_token.astype(np.int64)
    own_counts[:GROUPS] = 0
    log_masses = np.concatenate([np.log10(in_groups + distinct + 1), np.zeros(len(table))])
    tasks = training_tasks(totals["bytes"], len(by_token))
    model = train(training, table, by_token, tasks) if totals["n"] else initial(by_token)
    shared = spark.sparkContext.broadcast(Scorer(model, table, frequent, own_counts, log_masses))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            heads, rare = shared.value.heads([tokens_of(t) for t in utf8(batch, "text")])
            rows = batch.column("row").to_pylist()
            tokens = [f" {r}".encode() for r in rows] + [t for c in rare for t in c]  # no word has a blank
            n = [0] * len(rows) + [x for c in rare for x in c.values()]
            owner = rows + [r for r, c in zip(rows, rare) for _ in c]
            more = len(tokens) - len(rows)
            ids = pa.concat_arrays([batch.column("doc_id"), pa.nulls(more, batch.column("doc_id").type)])
            numbers = [
                pa.array([h[i] for h in heads] + [None] * more, pa.float64() if i in (2, 3) else pa.int64()) for i in range(4)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner, pa.int64()), pa.array(tokens, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), ids, *numbers],
                ["row", "token", "n", "doc_id", "tokens", "known", "base", "model"],
            )

    key = texts.schema["doc_id"].dataType.simpleString()
    parts = texts.mapInArrow(
        run, f"row long, token string, n long, doc_id {key}, tokens long, known long, base double, model double"
    )
    looked_up = parts.join(counts.where(F.col("c") < least), "token", "left")
    c = F.coalesce("c", F.lit(0))
    by_row = looked_up.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("tokens").alias("n_tokens"),
        (F.sum("known") + F.sum(F.when(c > 0, F.col("n")).otherwise(0))).alias("n_known"),
        F.sum("base").alias("base"),
        F.sum("model").alias("model"),
        F.sum(F.col("n") * F.log10(c + 1)).alias("rare"),
    )
    all_mass = F.lit(math.log10(totals["n"] + totals["v"] + 1))
    return by_row.select(
        "doc_id",
        (rest == held_out).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(totals["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rare") - F.col("n_tokens") * all_mass).alias("base_score"),
        (F.col("model") + F.col("rare")).alias("score"),
    )
