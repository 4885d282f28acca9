from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lakekit.operators import centers, learning

SETTINGS = [("kmeans", 2), ("kmeans", 4), ("kmeans", 5), ("bisecting", 2), ("bisecting", 4), ("bisecting", 5)]


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(2)
    middle = np.array([[0, 0, 0], [10, 0, 0], [0, 12, 0], [11, 11, 3]])
    return np.concatenate([m + rng.normal(0, 1, (40 + 30 * i, 3)) for i, m in enumerate(middle)])


@pytest.fixture(scope="module")
def vectors(spark, points):
    return spark.createDataFrame([(p.tolist(),) for p in points], "v array<double>").repartition(4)


def settings():
    return [centers.Setting(a, k, 7) for a, k in SETTINGS]


def test_together_as_alone_and_in_as_many_passes(vectors, monkeypatch):
    passes = []
    real = centers.sums_per_center
    monkeypatch.setattr(centers, "sums_per_center", lambda *a: passes.append(len(a[1])) or real(*a))
    together = centers.fit_all(vectors, settings())
    all_passes, alone, longest = len(passes), [], 0
    for s in settings():
        passes.clear()
        alone += centers.fit_all(vectors, [s])
        longest = max(longest, len(passes))
    assert all_passes == longest
    for a, b in zip(together, alone, strict=True):
        for x, y in zip(a if isinstance(a, list) else [(a, a)], b if isinstance(b, list) else [(b, b)], strict=True):
            assert np.allclose(x[0], y[0]) and np.allclose(x[1], y[1])


def test_against_plain_numpy(vectors, points):
    found = dict(zip(SETTINGS, centers.fit_all(vectors, settings()), strict=True))
    for k in (2, 4, 5):
        at = found["kmeans", k]
        label = ((points[:, None] - at) ** 2).sum(2).argmin(1)
        assert len(at) == k
        moved = np.array([points[label == i].mean(0) for i in range(k)])
        assert np.allclose(at, moved, atol=1e-3)  # a fixed point of Lloyd's step
    four = ((points[:, None] - found["kmeans", 4]) ** 2).sum(2).argmin(1)
    assert sorted(np.bincount(four).tolist()) == [40, 70, 100, 130]
    for k in (2, 4, 5):
        tree = found["bisecting", k]
        label = centers.descend(points, tree)
        assert len(set(label.tolist())) == k
        assert np.allclose(tree[-1][0], [points[label == i].mean(0) for i in range(k)], atol=1e-3)
        parents = [centers.descend(points, tree[:-1])[label == i] for i in range(k)] if len(tree) > 1 else []
        assert all(len(set(p.tolist())) == 1 for p in parents)


def test_silhouettes_as_spark_ml(spark, vectors):
    trials = centers.fit_all(vectors, settings())
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="label")
    for trial, (clusters, score) in zip(trials, centers.silhouettes(vectors, trials), strict=True):
        labelled = vectors.withColumn("label", centers.label_of(F.col("v"), trial)).withColumn("features", array_to_vector("v"))
        assert clusters == labelled.select("label").distinct().count()
        assert score == pytest.approx(evaluator.evaluate(labelled), abs=1e-9)


def test_odd_tables(spark):
    same = spark.createDataFrame([([1.0, 2.0],)] * 9, "v array<double>")
    two = spark.createDataFrame([([0.0],), ([5.0],)], "v array<double>")
    for df, clusters in ((same, 1), (two, 2)):
        tried = [centers.Setting(a, 3, 1) for a in ("kmeans", "bisecting")]
        for found, score in centers.silhouettes(df, centers.fit_all(df, tried)):
            assert found == clusters and score == (-1.0 if clusters == 1 else 0.0)
    with pytest.raises(ValueError, match="no rows"):
        centers.fit_all(same.limit(0), [centers.Setting("kmeans", 2, 1)])


def test_reruns_agree(spark, vectors):
    df = vectors.withColumn("features", array_to_vector("v")).drop("v")
    reports = [learning.cluster_search(df, ("kmeans", "bisecting"), (3, 4), (1, 2))[0].collect() for _ in range(2)]
    for a, b in zip(*reports, strict=True):
        assert a[:4] == b[:4] and a.best == b.best and a.silhouette == pytest.approx(b.silhouette)
    best = [r for r in reports[0] if r.best]
    assert len(best) == 1 and best[0].k == 4 and best[0].silhouette > 0.8
