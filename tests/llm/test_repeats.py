from __future__ import annotations

import hashlib
import random
import time

import numpy as np

from lakekit.llm import catalog, repeats


def brute(rows):
    """The contract by a dictionary of all windows, in order of the documents."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            w = data[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(df):
    return sorted(map(tuple, repeats.remove_repeats(df).drop("kept").collect()), key=repr)


def prose(rng, n):
    return "".join(rng.choice(["ab ", "the ", "größe ", "x", "of it ", "né. ", "\n"]) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passages = [prose(rng, 60) for _ in range(4)] + [prose(rng, 200)]
    texts = ["", None, "short", "a" * 99, "a" * 100, "a" * 350, "ab" * 200, "a" * 100]
    for _ in range(60):
        parts = [prose(rng, rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            parts += [p[a : a + rng.randrange(len(p))], prose(rng, rng.randrange(30))]
        texts.append("".join(parts))
    texts += rng.sample(texts[8:], 8)
    rng.shuffle(texts)
    return [(3 * i, t) for i, t in enumerate(texts)]


def test_against_all_windows(spark, monkeypatch):
    for seed, most in ((1, 32), (2, 1), (3, 3)):
        monkeypatch.setattr(repeats, "MOST_SORTED", most)
        rows = corpus(seed)
        df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, part int, z string")
        assert run(df) == sorted(brute(rows), key=repr)


def test_ended_steps_leave_no_shuffles(spark):
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        blocks = manager.getAllBlocks().mkString(" ").split()
        return {b for b in blocks if b.startswith("shuffle_")}

    before = shuffles()
    repeats.remove_repeats(spark.createDataFrame(corpus(4), "doc_id long, text string"))
    until = time.time() + 20
    while (left := shuffles() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_many_surroundings_take_few_rows(spark, monkeypatch):
    rng = random.Random(5)
    passage, gram = prose(rng, 120), prose(rng, 16)[:24]
    ends = ["".join(rng.choices("abcdefghij", k=150)) for _ in range(160)]
    rows = [(i, ends[2 * i] + (passage if i % 2 else gram) + ends[2 * i + 1]) for i in range(80)]
    wanted = [(i, 0, 7, 170, 120, 160, True) for i in range(80)]
    df = spark.createDataFrame([(i, i, 0, t) for i, t in rows], "doc_id long, doc long, part long, text string")
    wanted = spark.createDataFrame(wanted, "doc long, part long, key long, place long, first long, last long, many boolean")
    assert repeats._surroundings(wanted, repeats.packed_texts(df)).count() == 80

    counts, windows = [], repeats._windows
    monkeypatch.setattr(repeats, "_windows", lambda around: counts.append(windows(around).count()) or windows(around))
    monkeypatch.setattr(repeats, "MOST_SORTED", 4)
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(brute(rows), key=repr)
    # At either end of a passage some run of RUN windows has shared and other windows.
    assert len(counts) == 1 and 0 < counts[0] <= 40 * 2 * 2 * repeats.RUN


def test_odd_rows(spark):
    text = prose(random.Random(9), 100)
    rows = [(5, text), (5, text), (None, text), (None, None), (7, text + "é" * 100_000)]
    got = run(spark.createDataFrame(rows, "doc_id long, text string"))
    n = len(text.encode())
    assert [r[:3] for r in got if r[0] == 5] == [(5, n, 0)] * 2
    assert [r[:3] for r in got if r[0] == 7] == [(7, n + 200_000, n + 200_000 - 2)]
    assert sorted(r[:3] for r in got if r[0] is None) == [(None, 0, 0), (None, n, n)]
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []
    assert run(spark.createDataFrame([(1, "x"), (2, "y" * 100)], "doc_id long, text string"))[1][2] == 0


def test_suffix_order_is_lexicographic():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    group = np.array([rng.randrange(3) for _ in texts])
    with np.errstate(over="ignore"):
        order = repeats.suffix_order(repeats.PrefixHashes(data), data, start, size, group)
    assert [(group[i], texts[i]) for i in order] == sorted((g, t) for g, t in zip(group, texts))


def test_every_window_has_one_anchor_by_content():
    text = prose(random.Random(4), 400).encode()
    a, b = repeats.Anchors(text), repeats.Anchors(b"other start " + text)
    assert a.first[0] == 0 and (a.first[1:] == a.last[:-1] + 1).all() and a.last[-1] == len(text) - 100
    owner = {s: p for p, f, e in zip(a.place, a.first, a.last) for s in range(f, e + 1)}
    other = {s: p for p, f, e in zip(b.place, b.first, b.last) for s in range(f, e + 1)}
    assert all(s <= p <= s + 76 and other[s + 12] == p + 12 for s, p in owner.items())


def test_query_against_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, catalog.QUERIES["op3_suffix_repeats"](spark, folder).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)
