from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from lakekit.llm import catalog, quality, toxicity


def test_margin_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(0)
    model = toxicity.FactorizationMachine(0.5, np.array([2, 5, 9]), rng.normal(size=3), rng.normal(size=(3, 4)))
    lists = [np.array([2, 5, 9]), np.array([3, 5]), np.array([], np.int64)]
    pairs = [(0, 1), (0, 2), (1, 2)]
    wanted = 0.5 + model.weights.sum() + sum(model.factors[i] @ model.factors[j] for i, j in pairs)
    assert np.allclose(model.margins(lists), [wanted, 0.5 + model.weights[1], 0.5])


def test_a_pair_is_learned_that_linear_weights_miss():
    """Label 1 for "fool" with "they", or neither with "sun": each word alone tells nothing about one side."""
    rng = random.Random(2)
    texts, labels = [], []
    for _ in range(3000):
        insult, group = rng.random() < 0.6, rng.random() < 0.6
        words = [f"w{rng.randrange(40)}" for _ in range(6)] + ["fool"] * insult + ["they"] * group
        texts.append(toxicity.terms_of(" ".join(words).encode()))
        labels.append(int(insult and group))
    model = toxicity.fit(texts[:2000], np.array(labels[:2000]))
    z = model.margins(texts[2000:])
    assert ((z >= 0) == np.array(labels[2000:])).mean() > 0.97
    only, both = model.margins([toxicity.terms_of(t) for t in (b"fool w1 w2", b"fool they w1 w2")])
    assert only < 0 < both


def pairs(seed, n):
    """Two words that are each as often toxic as the average: always toxic together, never alone, else by chance."""
    rng = random.Random(seed)
    texts, labels, both = [], [], []
    for _ in range(n):
        a, b = rng.random() < 0.3, rng.random() < 0.3
        words = [f"w{rng.randrange(400)}" for _ in range(20)] + ["fool"] * a + ["they"] * b
        texts.append(toxicity.terms_of(" ".join(words).encode()))
        labels.append(1 if a and b else 0 if a or b else int(rng.random() < 0.43))
        both.append(a + b)
    return texts, np.array(labels), np.array(both)


def test_words_that_tell_nothing_alone_are_learned_as_a_pair():
    texts, labels, held = pairs(0, 12_000)
    share = [labels[[w in set(t.tolist()) for t in texts]].mean() for w in (toxicity.terms_of(b"fool")[0], toxicity.terms_of(b"they")[0])]
    assert max(abs(s - labels.mean()) for s in share) < 0.03
    model = toxicity.calibrated(texts, labels)
    texts, _, held = pairs(1, 4000)
    marked = model.margins(texts) >= 0
    assert marked[held == 2].mean() >= 0.95 and marked[held == 1].mean() < 0.05


def test_calibration_keeps_the_order_and_gives_odds():
    texts, labels, _ = pairs(2, 6000)
    raw, model = toxicity.fit(texts, labels), toxicity.calibrated(texts, labels)
    assert len(model.terms) and len(raw.terms)
    texts, labels, _ = pairs(3, 4000)
    p = 1 / (1 + np.exp(-np.clip(model.margins(texts), -35, 35)))
    for low, high in ((0, 0.2), (0.3, 0.6), (0.9, 1)):
        inside = (p >= low) & (p <= high)
        assert inside.sum() < 50 or abs(labels[inside].mean() - p[inside].mean()) < 0.15
    few = toxicity.calibrated(texts[:20], labels[:20])
    same = toxicity.fit(texts[:20], labels[:20])
    assert few.bias == same.bias


def test_scores_of_the_query_by_plain_numpy(spark, folder):
    """Fit and score restated: every pair of terms, one text at a time."""
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rest = quality.remainder(F.col("doc_id"), 5)
    model = toxicity.train(docs.select("doc_id", "text"), labels.where(rest != 0).selectExpr("doc_id", "toxic AS label"), 12_000)
    place = {t: i for i, t in enumerate(model.terms.tolist())}
    scores = {r["doc_id"]: r["score"] for r in catalog.QUERIES["op2_factorization_machine"](spark, folder).collect()}
    for r in docs.select("doc_id", "text").limit(60).collect():
        own = [place[t] for t in toxicity.terms_of((r["text"] or "").encode()).tolist() if t in place]
        z = model.bias + sum(model.weights[i] for i in own)
        z += sum(float(model.factors[i] @ model.factors[j]) for n, i in enumerate(own) for j in own[:n])
        assert abs(scores[r["doc_id"]] - 1 / (1 + np.exp(-np.clip(z, -35, 35)))) < 1e-9


def test_ranking_of_held_out_rows(spark, folder):
    sf = folder.replace("sf0.001", "sf0.1")
    rows = catalog.QUERIES["op2_factorization_machine"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    held = rows.where("held_out").select("score", "toxic").toPandas()
    order = held["score"].rank().to_numpy()
    toxic = held["toxic"].to_numpy() == 1
    area = (order[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert area >= 0.97


def test_held_out_accuracy(spark, folder):
    sf = folder.replace("sf0.001", "sf0.1")
    rows = catalog.QUERIES["op2_factorization_machine"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_are_not_read(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = quality.remainder(F.col("doc_id"), 5) == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(toxicity.classify(docs, labels).collect()) == sorted(toxicity.classify(docs, turned).collect())


def test_odd_rows(spark):
    docs = [(1, "what a fool", "x"), (1, "what a fool", "x"), (2, None, "x"), (3, "", "x"), (None, "z " * 50_000, "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, None), (None, 1), (9, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0), labels.where("toxic = 1")):
        out = toxicity.classify(frame, known).collect()
        assert len(out) == len(docs) and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.classify(frame.limit(0), labels).count() == 0
