from __future__ import annotations

import zlib

import numpy as np
import pytest

from lakekit.llm import catalog, quality


def test_margin_is_the_difference_of_gaussian_log_densities():
    rng = np.random.default_rng(0)
    d = len(quality.FEATURES)
    data = {c: rng.normal(c, 1 + c, (200, d)) for c in (0, 1)}
    model = quality.fit({c: (200, x.sum(0), x.T @ x) for c, x in data.items()}, 0.3, 0.01)
    pooled = np.diag((data[0].var(0) + data[1].var(0)) / 2)
    x = rng.normal(0, 2, (5, d))
    logs = []
    for c in (0, 1):
        s = 0.7 * np.cov(data[c].T, bias=True) + 0.3 * pooled + 0.01 * np.eye(d)
        diff = x - data[c].mean(0)
        logs.append(-0.5 * (np.sum(diff @ np.linalg.inv(s) * diff, axis=1) + np.linalg.slogdet(s)[1]))
    assert model.margin(x) == pytest.approx(logs[1] - logs[0])


def test_held_out_accuracy(spark, folder):
    sf = folder.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = catalog.QUERIES["op7_quality_discriminant"](spark, sf)
    rows = scored.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_are_not_read(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    held = quality.remainder(F.col("doc_id"), 4) == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(quality.classify(docs, labels).collect()) == sorted(quality.classify(docs, turned).collect())


def test_odd_rows(spark):
    docs = [(1, "good words here and there", "x"), (1, "good words here and there", "x"), (2, None, "x"), (3, "", "x")]
    docs += [(None, "z" * 100_000, "x"), (4, "### $$$ !!! |", "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, None), (None, 1), (9, 0)], "doc_id long, quality int")
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        out = quality.classify(frame, known).collect()
        assert len(out) == len(docs) and all(0 <= r["score"] <= 1 for r in out)
        assert [r["score"] for r in out if r["doc_id"] == 2] == [r["score"] for r in out if r["doc_id"] == 3]
    assert quality.classify(frame.limit(0), labels).count() == 0
