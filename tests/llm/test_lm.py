from __future__ import annotations

import math
import pickle
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lakekit.llm import catalog, lm


def tokens(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split() + [b""]


def base_scores(rows):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(t for (_, text), h in zip(rows, held) if not h for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, text), h in zip(rows, held):
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        out.append((i, h, len(own), sum(counts[t] > 0 for t in own), n, base))
    return out


def check(rows, got):
    order = lambda r: (repr(r[0]), r[2], r[5])
    wanted = sorted(base_scores(rows), key=order)
    got = sorted(map(tuple, got), key=order)
    assert [g[:5] for g in got] == [w[:5] for w in wanted]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in wanted])
    assert all(g[6] < 0 and math.isfinite(g[6]) for g in got)


def test_probabilities_add_up_to_one():
    model = lm.initial(np.array([5.0, 3, 2, 9]))
    history = np.array([[0, 1, 2, 3, 1]])
    total = sum(math.exp(model.log_probabilities(history, np.array([i]))[0]) for i in range(4))
    assert total == pytest.approx(1, abs=1e-5)


def test_training_learns_what_follows():
    rng = np.random.default_rng(0)
    ids = np.empty(30000, np.int32)
    ids[0] = 2
    for i in range(1, len(ids)):
        ids[i] = (ids[i - 1] - 2 + 1) % 6 + 2 if rng.random() < 0.9 else rng.integers(0, 8)
    ids += lm.GROUPS
    trainer = lm.Trainer(lm.initial(np.bincount(ids, minlength=lm.GROUPS + 8)), 1)
    history, following = lm.examples([ids], lm.CONTEXT)
    before = trainer.model.log_probabilities(history, following).mean()
    for _ in range(4):
        for a in range(0, len(following), 256):
            trainer.step(history[a : a + 256], following[a : a + 256])
    after = trainer.model.log_probabilities(history, following).mean()
    assert after > before + 0.8


def test_base_scores_with_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["The", "the", "ü", "x\x00y", f"w{rng.randrange(50)}"]) for _ in range(20))) for i in range(60)]
    rows += [(None, "the end"), (3, "the"), (3, "the"), (70, None), (71, ""), (72, "new " * 40_000), (73, "a b \t\n c")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, token int")
    for limit in (300_000, 10, 0):
        check(rows, lm.score_texts(df, frequent_limit=limit).collect())
    assert lm.score_texts(df.limit(0)).count() == 0
    only = [(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2]
    check(only, lm.score_texts(spark.createDataFrame(only, "doc_id long, text string")).collect())


def test_query_and_held_out_likelihood(spark, folder):
    sf = folder.replace("sf0.001", "sf0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = catalog.QUERIES["op5_log_bilinear"](spark, sf).collect()
    check(rows, got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.99 * sum(r["base_score"] for r in held)


def test_every_position_is_learned(spark):
    """Texts of two words: the second word and the end stand at positions that a stride of four or eight never takes."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'alpha beta' AS text").repartition(1)
    held = lm.score_texts(docs).where("held_out").first()
    assert held["score"] > 0.5 * held["base_score"]


def test_context_helps_with_words_beyond_the_most_frequent(spark):
    """Each text has words of one of 20 topics; all words are about as frequent and end alike."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{i % 20 * 75 + rng.randrange(75):04d}xx" for _ in range(300))) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    held = lm.score_texts(docs).where("held_out").collect()
    assert sum(r["score"] for r in held) > 0.85 * sum(r["base_score"] for r in held)


def test_tokens_with_vectors_grow_with_the_vocabulary():
    counts = {b"t%d" % i: 100 + i for i in range(5000)} | {b"rare": 3}
    table = lm.TokenTable.of(counts, lm.OWN_COUNT)
    assert len(table) == 5001 and table[b"rare"] < lm.GROUPS < table[b"t0"]
    model = lm.initial(np.arange(400.0))
    history = np.array([[0, 1, 2, 3, 1]] * 400)
    assert np.exp(model.log_probabilities(history, np.arange(400))).sum() == pytest.approx(1, abs=1e-4)


def test_parts_of_training_tasks_stay_small_beside_the_texts():
    """64 tasks, each with a model of 150,000 tokens, once shuffled 3.7 times as much as half a GB of input."""
    for text_bytes, tokens in ((740_000_000, 150_000), (150_000_000, 50_000), (40_000_000_000, 300_000), (3000, 100)):
        tasks = lm.training_tasks(text_bytes, tokens)
        assert 1 <= tasks <= lm.TRAINING_TASKS
        assert tasks == 1 or lm.ROUNDS * tasks * tokens * 4 * (2 * lm.DIMENSIONS + 1) <= lm.PARTS_SHARE * text_bytes
    assert lm.training_tasks(40_000_000_000, 300_000) == lm.TRAINING_TASKS


def test_parameters_of_a_pickled_model_are_scattered_to_fast():
    """Tasks get the model pickled; numpy adds at places slowly unless the array's type object is numpy's own."""
    model = pickle.loads(pickle.dumps(lm.initial(np.arange(400.0))))
    trainer = lm.Trainer(model, 1)
    assert all(getattr(trainer.model, name).dtype is np.dtype("float32") for name in lm.PARAMETERS)


def test_runs_take_every_position_once_with_its_own_contexts():
    rng = np.random.default_rng(2)
    texts = [rng.integers(lm.GROUPS, lm.GROUPS + 300, n).astype(np.int32) for n in (1, 2, 40, 333, 7, 16)]
    history, following = lm.examples(texts, lm.CONTEXT)
    runs, known = lm.runs_of(texts, lm.CONTEXT)
    assert known.sum() == len(following) == sum(map(len, texts))
    windows = np.lib.stride_tricks.sliding_window_view(runs, lm.CONTEXT + 1, axis=1)[known]
    assert (windows[:, -1] == following).all() and (windows[:, -2::-1] == history).all()
    one, other = (lm.Trainer(lm.initial(np.arange(1.0, 400)), 1) for _ in range(2))
    seen = [[], []]
    for trainer, vectors in zip((one, other), seen):
        learn = trainer._predict
        trainer._predict = lambda v, f, vectors=vectors, learn=learn: vectors.append((v, f)) or learn(v, f)
    one.step(history, following)
    other.step_runs(runs, known)
    (a, b), (c, d) = seen[0][0], seen[1][0]
    assert (b == d).all() and a == pytest.approx(c, abs=1e-5)
    assert one.model.scales == pytest.approx(other.model.scales, abs=1e-4)
    assert one.model.targets == pytest.approx(other.model.targets, abs=1e-4)


def test_probabilities_of_long_vectors():
    """Logits beyond the range of 32-bit exponentials."""
    model = lm.initial(np.arange(400.0))
    model.contexts[:] *= 300
    history, following = np.array([[0, 1, 2, 3, 1]] * 400), np.arange(400)
    total = model.log_probabilities(history, following)
    assert np.isfinite(total).all() and np.exp(total).sum() == pytest.approx(1, abs=1e-4)
    vector = (model.contexts[history[0]] * model.scales).sum(axis=0).astype(float)
    logits = model.class_targets.astype(float) @ vector + model.class_biases
    kind = np.searchsorted(model.starts, model.place[7], "right") - 1
    low, high = model.starts[kind], model.starts[kind + 1]
    inside = model.targets[low:high].astype(float) @ vector + model.biases[low:high]
    want = logits[kind] - np.logaddexp.reduce(logits) + inside[model.place[7] - low] - np.logaddexp.reduce(inside)
    assert total[7] == pytest.approx(want, rel=1e-4, abs=1e-3)
