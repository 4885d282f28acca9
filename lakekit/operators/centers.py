"""K-means and bisecting k-means of many settings at once: every pass over the rows moves the centers of all of them.

A pass is one scan: each task finds the nearest centers of its rows by one matrix product with the centers of all settings,
and gives out one row of sums per center. Only centers and their sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_STEPS = 20
TOLERANCE = 1e-4
# Rows per wanted cluster from which the first centers are drawn.
SAMPLE_PER_CLUSTER = 40


def nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Number of the nearest center of each point; of equally near ones the first."""
    distance = (centers * centers).sum(1) - 2 * points @ centers.T
    return distance.argmin(1)


def plus_plus(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """First centers: points drawn with probabilities that grow with the squared distance from those drawn before."""
    rng = np.random.default_rng(seed)
    chosen = [points[rng.integers(len(points))]]
    far = ((points - chosen[0]) ** 2).sum(1)
    while len(chosen) < min(k, len(points)) and far.sum() > 0:
        chosen.append(points[rng.choice(len(points), p=far / far.sum())])
        far = np.minimum(far, ((points - chosen[-1]) ** 2).sum(1))
    return np.array(chosen)


@dataclass
class Setting:
    """One algorithm, number of clusters and seed, with its centers so far."""

    algorithm: str
    k: int
    seed: int
    centers: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    done: bool = False


class Flat:
    """Lloyd's steps for one setting."""

    def __init__(self, setting: Setting, sample: np.ndarray):
        self.setting, self.steps = setting, 0
        setting.centers = plus_plus(sample, setting.k, setting.seed)

    def trial(self) -> np.ndarray:
        return self.setting.centers

    def update(self, sums: np.ndarray, counts: np.ndarray) -> None:
        setting = self.setting
        moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], setting.centers)
        shift = ((moved - setting.centers) ** 2).sum(1).max(initial=0)
        setting.centers, self.steps = moved, self.steps + 1
        setting.done = shift <= TOLERANCE**2 or self.steps >= MAX_STEPS


class Bisecting:
    """Every cluster in two, level by level; at the last level the largest ones, as many as are still wanted.

    Points go down the tree, so a cluster's halves are looked for among its own points: `paths` names for every trial center
    the center whose points it may take.
    """

    def __init__(self, setting: Setting, sample: np.ndarray):
        self.setting, self.sample = setting, sample
        setting.centers = sample.mean(0, keepdims=True)
        self.tree: list[tuple[np.ndarray, np.ndarray]] = []  # per level: centers, and the parent of each
        self.counts = np.array([np.inf])
        self._open()

    def _open(self) -> None:
        """Start the next level, or end."""
        setting, self.steps = self.setting, 0
        now = len(setting.centers)
        self.split = np.argsort(-self.counts, kind="stable")[: setting.k - now]
        self.split = np.sort(self.split[self.counts[self.split] > 1])
        if now >= setting.k or not len(self.split):
            setting.done = True
            return
        rng = np.random.default_rng([setting.seed, now])
        inside = descend(self.sample, self.tree) if self.tree else np.zeros(len(self.sample), int)
        centers, parents = [], []
        for i, center in enumerate(setting.centers):
            own = self.sample[inside == i]
            spread = own.std(0) if len(own) > 1 else np.abs(center) * 1e-3 + 1e-3
            noise = rng.normal(size=center.shape) * spread * 0.5
            for c in (center - noise, center + noise) if i in self.split else (center,):
                centers.append(c)
                parents.append(i)
        self.trial_centers, self.parents = np.array(centers), np.array(parents)

    def trial(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [*self.tree, (self.trial_centers, self.parents)]

    def update(self, sums: np.ndarray, counts: np.ndarray) -> None:
        moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], self.trial_centers)
        shift = ((moved - self.trial_centers) ** 2).sum(1).max(initial=0)
        self.trial_centers, self.steps = moved, self.steps + 1
        if shift <= TOLERANCE**2 or self.steps >= MAX_STEPS:
            self.tree.append((moved, self.parents))
            empty_halves = (counts == 0) & np.isin(self.parents, self.split)
            self.counts = np.where(empty_halves, 0, counts).astype(float)
            self.setting.centers = moved
            self._open()


def descend(points: np.ndarray, tree: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Number of the last level's center that each point comes to."""
    at = np.zeros(len(points), int)
    for centers, parents in tree:
        distance = (centers * centers).sum(1) - 2 * points @ centers.T
        distance[parents[None, :] != at[:, None]] = np.inf
        at = distance.argmin(1)
    return at


def assign(points: np.ndarray, trial) -> np.ndarray:
    return nearest(points, trial) if isinstance(trial, np.ndarray) else descend(points, trial)


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            yield flat.reshape(batch.num_rows, -1)


def sums_per_center(vectors: DataFrame, trials: Sequence) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each trial: sums, counts and sums of squares of the rows of each of its centers; one scan for all trials."""
    sizes = [len(t if isinstance(t, np.ndarray) else t[-1][0]) for t in trials]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for points in _batches(batches):
            if totals is None:
                totals = [np.zeros((n, points.shape[1] + 2)) for n in sizes]
            wide = np.column_stack([points, np.ones(len(points)), (points * points).sum(1)])
            for total, trial in zip(totals, trials, strict=True):
                label = assign(points, trial)
                order = np.argsort(label, kind="stable")
                starts = np.flatnonzero(np.diff(label[order], prepend=-1))
                total[label[order][starts]] += np.add.reduceat(wide[order], starts, axis=0)
        if totals is not None:
            rows = [(t, c, list(r)) for t, total in enumerate(totals) for c, r in enumerate(total) if r[-2]]
            t, c, sums = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(c, pa.int32()), pa.array(sums, pa.list_(pa.float64()))], ["t", "c", "s"])

    added = vectors.mapInArrow(run, "t int, c int, s array<double>").groupBy("t", "c")
    found = added.agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s")).collect()
    width = len(found[0]["s"]) if found else 2
    totals = [np.zeros((n, width)) for n in sizes]
    for r in found:
        totals[r["t"]][r["c"]] = r["s"]
    return [(t[:, :-2], t[:, -2], t[:, -1]) for t in totals]


def silhouettes(vectors: DataFrame, trials: Sequence) -> list[tuple[int, float]]:
    """(clusters with rows, mean silhouette by squared distances) of each trial: two scans for all of them.

    A row's mean squared distance from a cluster follows from the cluster's sums. Fewer than two clusters score -1; a row that
    is alone in its cluster counts 0.
    """
    stats = sums_per_center(vectors, trials)
    kept = [np.flatnonzero(counts > 0) for _, counts, _ in stats]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(trials))
        for points in _batches(batches):
            norms = (points * points).sum(1)
            for i, (trial, (sums, counts, squares), there) in enumerate(zip(trials, stats, kept, strict=True)):
                if len(there) < 2:
                    continue
                n = counts[there]
                mean = norms[:, None] + squares[there] / n - 2 * points @ (sums[there] / n[:, None]).T
                own = np.searchsorted(there, assign(points, trial))
                rows = np.arange(len(points))
                inside = np.maximum(mean[rows, own], 0) * n[own] / np.maximum(n[own] - 1, 1)
                mean[rows, own] = np.inf
                outside = np.maximum(mean.min(1), 0)
                larger = np.maximum(inside, outside)
                score = np.where((n[own] > 1) & (larger > 0), (outside - inside) / np.where(larger > 0, larger, 1), 0)
                totals[i] += score.sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(trials)), pa.int32()), pa.array(totals, pa.float64())], ["t", "s"])

    added = {r["t"]: r["s"] for r in vectors.mapInArrow(run, "t int, s double").groupBy("t").agg(F.sum("s").alias("s")).collect()}
    return [
        (len(there), float(added[i] / counts.sum()) if len(there) > 1 else -1.0)
        for i, ((_, counts, _), there) in enumerate(zip(stats, kept, strict=True))
    ]


METHODS = {"kmeans": Flat, "bisecting": Bisecting}


def fit_all(vectors: DataFrame, settings: Sequence[Setting]) -> list:
    """The trial (centers, or tree of centers) that each setting ends with; `vectors` has one array column `v`.

    The first centers come from a sample of bounded size, the rows with the smallest hashes, so that reruns agree.
    """
    wanted = SAMPLE_PER_CLUSTER * max(s.k for s in settings)
    sample = np.array([r["v"] for r in vectors.orderBy(F.xxhash64("v"), "v").limit(wanted).collect()])
    if not len(sample):
        raise ValueError("no rows to cluster")
    runs = [METHODS[s.algorithm](s, sample[: SAMPLE_PER_CLUSTER * s.k]) for s in settings]
    while open_runs := [r for r in runs if not r.setting.done]:
        for run, (sums, counts, _) in zip(open_runs, sums_per_center(vectors, [r.trial() for r in open_runs]), strict=True):
            run.update(sums, counts)
    return [r.setting.centers if isinstance(r, Flat) else r.tree or r.setting.centers for r in runs]


def label_of(vector: Column, trial) -> Column:
    """The number of a row's cluster, by an Arrow function."""

    @F.pandas_udf("int")
    def label(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype="int32")
        return pd.Series(assign(np.stack(values.to_list()), trial).astype("int32"))

    return label(vector)
