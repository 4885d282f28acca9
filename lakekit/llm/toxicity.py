"""Toxicity by a factorization machine over hashed terms: linear weights plus learned interactions of all pairs of terms.

Terms of a text are its words and their first letters, each once. A pair of terms interacts by the product of their
factor vectors, so that words that are harmless alone can be toxic together, also in pairs that training never saw.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.llm.common import slices, utf8
from lakekit.llm.decontaminate import words_of
from lakekit.llm.quality import remainder

BUCKETS = 1 << 26
PREFIXES = (4, 5, 6)  # bytes
MAX_TRAINING_ROWS = 12_000
MIN_DOCUMENTS = 8  # of the training rows that hold a term
CALIBRATION = 5  # one training row in so many sets the scale of the margins instead of parameters
MIN_OF_CLASS = 5  # rows of either class that this takes
FACTORS = 4
EPOCHS = 12
BATCH = 256
RATE = 0.1
L1, L2 = 3e-3, 1e-2
THRESHOLD = 0.5


def terms_of(text: bytes) -> np.ndarray:
    """Distinct hashed terms of a text, sorted; none without words."""
    words = set(words_of(text))
    terms = set(words)
    for n in PREFIXES:
        terms.update([w[:n] + b"*" for w in words if len(w) > n])
    return np.unique(np.fromiter(map(xxhash.xxh32_intdigest, terms), np.int64, len(terms)) % BUCKETS)


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All terms one after the other, and the row of each."""
    terms = np.concatenate(lists) if lists else np.empty(0, np.int64)
    return terms, np.repeat(np.arange(len(lists)), [len(x) for x in lists])


@dataclass(frozen=True)
class FactorizationMachine:
    """Bias, the sorted terms that have parameters, their weights and factors."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, lists: list[np.ndarray]) -> np.ndarray:
        n = len(lists)
        found, row = _flat(lists)
        if not len(self.terms) or not len(found):
            return np.full(n, self.bias)
        place = np.minimum(np.searchsorted(self.terms, found), len(self.terms) - 1)
        known = self.terms[place] == found
        place, row = place[known], row[known]
        out = self.bias + np.bincount(row, self.weights[place], n)
        for f in self.factors.T:
            total = np.bincount(row, f[place], n)
            out += 0.5 * (total**2 - np.bincount(row, f[place] ** 2, n))
        return out


def fit(lists: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> FactorizationMachine:
    """Adagrad on the logistic loss, the rarer class weighted up; weights shrink to zero by L1, factors by L2.

    Terms of few rows get no parameters: they would only learn single rows by heart. No term is left out for telling nothing
    by itself, since it may tell something together with another one.
    """
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, float)
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    every = np.concatenate([*lists, np.empty(0, np.int64)])
    terms, counts = np.unique(every, return_counts=True)
    terms = terms[counts >= MIN_DOCUMENTS]
    if not len(terms) or labels.min(initial=1) == labels.max(initial=0):
        return FactorizationMachine(bias, np.empty(0, np.int64), np.empty(0), np.empty((0, FACTORS)))
    kept = []
    for x in lists:
        place = np.minimum(np.searchsorted(terms, x), len(terms) - 1)
        kept.append(place[terms[place] == x])
    rare = max((1 - labels).sum() / labels.sum(), 1.0)
    weight = np.where(labels > 0, rare, 1.0)
    size = len(terms)
    w, v = np.zeros(size), rng.normal(0, 0.01, (FACTORS, size))
    gw, gv, gb = np.full(size, 1e-4), np.full((FACTORS, size), 1e-4), 1e-4
    for _ in range(EPOCHS):
        order = rng.permutation(len(kept))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            idx, row = _flat([kept[i] for i in chosen])
            n = len(chosen)
            sums = np.stack([np.bincount(row, f[idx], n) for f in v])
            squares = sum(np.bincount(row, f[idx] ** 2, n) for f in v)
            z = bias + np.bincount(row, w[idx], n) + 0.5 * ((sums**2).sum(0) - squares)
            error = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - labels[chosen]) * weight[chosen] / n
            touched, inverse = np.unique(idx, return_inverse=True)
            grad = np.bincount(inverse, error[row], len(touched))
            gw[touched] += grad**2
            step = RATE / np.sqrt(gw[touched])
            moved = w[touched] - step * grad
            w[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * L1, 0)
            for f in range(FACTORS):
                grad = np.bincount(inverse, error[row] * (sums[f, row] - v[f, idx]), len(touched)) + L2 * v[f, touched]
                gv[f, touched] += grad**2
                v[f, touched] -= 0.3 * RATE * grad / np.sqrt(gv[f, touched])
            gb += error.sum() ** 2
            bias -= RATE * error.sum() / np.sqrt(gb)
    used = (np.abs(w) > 1e-3) | (np.abs(v).max(0) > 0.05)
    return FactorizationMachine(float(bias), terms[used], w[used], v[:, used].T.copy())


def calibrated(lists: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> FactorizationMachine:
    """Fits on most rows and scales the margins so that they give the others' odds: z becomes a z + b, by Newton steps.

    With too few rows of a class to do that, all rows are fitted and margins stay.
    """
    labels = np.asarray(labels, float)
    order = np.random.default_rng(seed).permutation(len(lists))
    kept = order[: len(order) // CALIBRATION]
    y = labels[kept]
    if min(y.sum(), (1 - y).sum()) < MIN_OF_CLASS:
        return fit(lists, labels, seed)
    rest = order[len(kept) :]
    model = fit([lists[i] for i in rest], labels[rest], seed)
    z = model.margins([lists[i] for i in kept])
    goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -35, 35)))
        slope, spread = p - goal, p * (1 - p) + 1e-9
        gradient = np.array([slope @ z + 1e-3 * (a - 1), slope.sum()])
        step = np.linalg.solve([[spread @ z**2 + 1e-3, spread @ z], [spread @ z, spread.sum()]], gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    if not (np.isfinite([a, b]).all() and a > 0):
        return model
    return FactorizationMachine(float(a * model.bias + b), model.terms, a * model.weights, np.sqrt(a) * model.factors)


def train(docs: DataFrame, labels: DataFrame, max_rows: int) -> FactorizationMachine:
    """Fits on about `max_rows` labelled rows, chosen by a hash of their ids; all of them if there are fewer.

    docs: (doc_id, text); labels: (doc_id, label). Only the terms of the chosen rows reach the driver.
    """
    known = labels.where(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    share = min(1.0, max_rows / max(known.count(), 1))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = docs.where(draw).join(known.where(draw), "doc_id")
    schema = "label int, terms array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            terms = pa.array([terms_of(t) for t in utf8(batch, "text")], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()), terms], ["label", "terms"])

    rows: pd.DataFrame = sample.select("label", "text").mapInArrow(run, schema).toArrow().to_pandas()
    rows["key"] = [(len(t), *t[:3], t.sum() if len(t) else 0) for t in rows["terms"]]
    rows = rows.sort_values("key", kind="stable")  # tasks may end in any order
    return calibrated(list(rows["terms"]), rows["label"].to_numpy())


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 5,
    held_out: int = 0,
    threshold: float = THRESHOLD,
    max_rows: int = MAX_TRAINING_ROWS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of the documents, in [0, 1]; higher is likelier toxic.

    Learns from labelled rows whose crc32(id as text) mod `folds` isn't `held_out`, about `max_rows` of them at most;
    labels other than 0 and 1 are left out, and a document labelled twice counts with its higher label. NULL and empty
    texts have no terms and get the score of the bias. With only one class, or no labels, every score is the smoothed
    share of class 1. Rows of the same id are scored one by one. Empty tables give no rows. Other columns don't matter.
    Scoring is one pass over whole texts without a shuffle; the model's size is bounded by the training rows.
    """
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    rest = remainder(F.col("doc_id"), folds)
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label"))
    model = train(texts, known.where(rest != held_out), max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([texts.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            z = np.clip(shared.value.margins([terms_of(t) for t in utf8(batch, "text")]), -35, 35)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-z)))], schema.names)

    return texts.mapInArrow(run, schema).select(
        "doc_id",
        (rest == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
