"""Quality classifier: regularised quadratic discriminant analysis over transformed statistics of documents.

Each class is a Gaussian with a covariance shrunk towards the diagonal of the common one. A document's score comes from
the difference of the two log-densities, whose Mahalanobis terms use Cholesky factors computed once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.llm.common import slices, stored, utf8

SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = ("words", "word_length", "symbols", "separators", "shouts", "upper", "digits", "repeats", "lines", "window")
SHRINKAGE = 0.1
RIDGE = 3e-3
TEMPERATURE = 4.0
THRESHOLD = 0.7
_WORD = re.compile(rb"[^ \t\n\v\f\r]+")


def _rate(part: float, whole: float, floor: float) -> float:
    """A share on a log scale: 0 for none, 1 for all, with changes below the floor of little weight."""
    return math.log1p(part / (max(whole, 1) * floor)) / math.log1p(1 / floor)


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text; all zeros for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    solid = sum(map(len, words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    runs = sum(map(bytes.__eq__, words, words[1:]))
    windows = set(zip(words, words[1:], words[2:]))
    # A word is expected to come back in long texts; what counts is the share of three-word windows that do.
    repeated = max(n - 2, 0) - len(windows)
    return [
        math.log1p(n) / 5,
        min(math.log(solid / n), 4.0),
        _rate(len(text) - len(text.translate(None, SYMBOLS)), solid, 0.01),
        _rate(words.count(b"|"), n, 0.01),
        _rate(text.count(b"!"), n, 0.02),
        _rate(len(text) - len(text.translate(None, UPPER)), solid, 0.05),
        _rate(len(text) - len(text.translate(None, b"0123456789")), solid, 0.05),
        _rate(runs, n, 0.02),
        _rate(len(lines) - len(set(lines)), len(lines), 0.05),
        _rate(repeated, n, 0.02),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the statistics of FEATURES) for every row; one pass over whole texts, no shuffle."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType)] + [T.StructField(n, T.DoubleType()) for n in FEATURES]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            values = np.array([statistics(t) for t in utf8(batch, "_text")]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(values[:, i]) for i in range(len(FEATURES)))], schema.names
            )

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("_text")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log-determinants of both classes; None where a class has no example."""

    means: tuple
    factors: tuple
    log_dets: tuple
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-density difference of class 1 and class 0, prior included."""
        if any(m is None for m in self.means):
            return np.full(len(x), self.prior)
        densities = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets):
            z = (x - mean) @ factor.T
            densities.append(-0.5 * (np.einsum("ij,ij->i", z, z) + log_det))
        return densities[1] - densities[0] + self.prior


def fit(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float, ridge: float) -> Discriminant:
    """Model from count, sum and sum of products of each class."""
    counts = [moments[c][0] if c in moments else 0.0 for c in (0, 1)]
    prior = math.log((counts[1] + 1) / (counts[0] + 1))
    if not all(counts):
        return Discriminant((None, None), (None, None), (None, None), prior)
    means = [moments[c][1] / counts[c] for c in (0, 1)]
    scatters = [moments[c][2] / counts[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = np.diag(np.diag((counts[0] * scatters[0] + counts[1] * scatters[1]) / sum(counts)))
    factors, dets = [], []
    for s in scatters:
        cholesky = np.linalg.cholesky((1 - shrinkage) * s + shrinkage * pooled + ridge * np.eye(len(s)))
        factors.append(np.linalg.inv(cholesky))
        dets.append(2 * float(np.log(np.diag(cholesky)).sum()))
    return Discriminant(tuple(means), tuple(factors), tuple(dets), prior)


def train(
    stats: DataFrame, labels: DataFrame, chosen: Column, shrinkage: float = SHRINKAGE, ridge: float = RIDGE
) -> Discriminant:
    """Fits on all labelled rows that `chosen` admits: two rows of moments reach the driver."""
    pairs = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
    known = labels.where(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = (
        stats.where(chosen)
        .join(known, "doc_id")
        .groupBy("label")
        .agg(
            F.count("*").alias("n"),
            *[F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)],
            *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}_{j}") for i, j in pairs],
        )
        .collect()
    )
    moments = {}
    for row in rows:
        products = np.zeros((len(FEATURES), len(FEATURES)))
        for i, j in pairs:
            products[i, j] = products[j, i] = row[f"p{i}_{j}"]
        moments[row["label"]] = (row["n"], np.array([row[f"s{i}"] for i in range(len(FEATURES))]), products)
    return fit(moments, shrinkage, ridge)


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of an id as text, modulo a divisor; the id NULL counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def probability(model: Discriminant, x: np.ndarray, temperature: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.margin(x) / temperature, -35, 35)))


def scores(stats: DataFrame, model: Discriminant, temperature: float = TEMPERATURE) -> DataFrame:
    """The statistics' rows with a score in (0, 1): the logistic function of the margin by a temperature.

    Statistics of one text depend on each other, so their joint densities overstate the evidence; the temperature evens
    that out without changing the order.
    """
    schema = T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)
            score = pa.array(probability(model, x, temperature))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), score], schema.names)

    return stats.mapInArrow(run, schema)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 4,
    held_out: int = 2,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of the documents, in [0, 1]; higher is likelier good.

    Learns from labelled rows whose crc32(id as text) mod `folds` isn't `held_out`; labels other than 0 and 1 are left
    out, and a document labelled twice counts with its higher label. NULL and empty texts have all statistics 0 and are
    scored like any other. With only one class, or no labels, every score is the smoothed share of class 1. Rows of the
    same id are scored one by one. Empty tables give no rows. Other columns don't matter.

    Statistics are computed in one pass and stored (80 bytes a row); labels join those, never the texts.
    """
    stats = stored(document_statistics(docs, id_col, text_col), "quality-statistics")
    rest = remainder(F.col("doc_id"), folds)
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label"))
    model = train(stats, known, rest != held_out)
    scored = scores(stats, model)
    return scored.select(
        "doc_id",
        (rest == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 4,
    held_out: int = 2,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents that `classify` predicts to be good, with all their columns; rows are judged where they are read."""
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label"))
    stats = document_statistics(docs, id_col, text_col)
    model = train(stats, known, remainder(F.col("doc_id"), folds) != held_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            x = np.array([statistics(t) for t in utf8(batch, text_col)]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(probability(model, x, TEMPERATURE) >= threshold))

    return docs.mapInArrow(run, docs.schema)
