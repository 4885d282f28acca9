from __future__ import annotations

import random

import numpy as np

from lakekit.llm import catalog, near_dups


def shingles(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(rows, k, percent=80):
    """(id, size, component, kept) by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_size = sorted(range(len(rows)), key=lambda i: len(sets[i]))
    for x, i in enumerate(by_size):
        for j in by_size[x + 1 :]:
            if not sets[i]:
                break
            if 100 * len(sets[i]) < percent * len(sets[j]):
                break
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    smallest = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            smallest[find(i)] = min(name, smallest.get(find(i), name))
    out = []
    for i, (name, _) in enumerate(rows):
        component = smallest.get(find(i)) if sets[i] else name
        out.append((name, len(sets[i]), component, name == component))
    return sorted(out, key=repr)


def linked(df, **options):
    return sorted(map(tuple, near_dups.link_near_duplicates(df, **options).collect()), key=repr)


def test_coordinates_estimate_similarity_and_all_fill():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [pool[:1000], pool[200:1200], pool[:1], pool[:3], pool[:150]]
    out = near_dups.sketches(sets, 128)
    assert (out != np.iinfo(np.uint64).max).all()
    assert abs((out[0] == out[1]).mean() - 800 / 1200) < 0.15
    alone = near_dups.sketches([sets[3]], 128)
    assert (alone[0] == out[3]).all()


def test_signatures_of_linked_pairs_stay_close():
    rng = np.random.default_rng(2)
    most = near_dups.bits_apart(80)
    for _ in range(40):
        pool = rng.integers(0, 2**63, 1250).astype(np.uint64)
        a, b = near_dups.signatures(near_dups.sketches([pool[:1125], pool[125:]], 200))
        assert sum(int(x).bit_count() for x in (a ^ b).view(np.uint64)) <= most
    far = near_dups.signatures(near_dups.sketches([rng.integers(0, 2**63, 300).astype(np.uint64) for _ in range(2)], 200))
    assert sum(int(x).bit_count() for x in (far[0] ^ far[1]).view(np.uint64)) > most


def test_parities_bound_the_difference():
    rng = np.random.default_rng(3)
    for n in (1, 50, 400):
        pool = np.unique(rng.integers(0, 2**63, n + 200).astype(np.uint64))
        a, b = pool[:n], pool[n // 3 : n + 20]
        bits = sum(int(x).bit_count() for x in (near_dups.parities(a) ^ near_dups.parities(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b)) and (n < 400 or bits > 0.6 * len(np.setxor1d(a, b)))


def family(rng, base, edits, n):
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", " \n", "one", "One", "a b c", "A B C", "a b c d e f"]
    texts += family(rng, " ".join(f"w{i}" for i in range(150)), 4, 60)
    texts += family(rng, " ".join(f"v{i}" for i in range(60)), 2, 30)
    chain = [f"c{i}" for i in range(140)]
    texts += [" ".join(chain[i : i + 90]) for i in range(0, 50, 4)]
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b c"), (None, "only null id"), (3, texts[3]), (3, "one")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, rep int")
    for k in (4, 5):
        assert linked(df, shingle=k) == brute(rows, k)
    assert linked(df.limit(0)) == []
    assert linked(spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")) == [(1, 1, 1, True), (2, 0, 2, True)]


def test_only_the_exact_last_round_is_enough(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "STAR_ROUNDS", 0)
    rng = random.Random(6)
    rows = list(enumerate(family(rng, " ".join(f"w{i}" for i in range(120)), 5, 40)))
    assert linked(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4) == brute(rows, 4)


def test_components_of_a_long_chain(spark):
    n = 60
    edges = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(n)], "a binary, b binary")
    labels = near_dups.components(edges).collect()
    assert len(labels) == n + 1 and len({bytes(r["root"]) for r in labels}) == 1


def test_query_against_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, catalog.QUERIES["op10_fast_sketching"](spark, folder).collect()), key=repr)
    assert got == brute(rows, 4)


def test_short_pairs_pass_the_signature_filter():
    rng = np.random.default_rng(6)
    for n in (4, 5, 6):
        long = [np.sort(rng.integers(0, 1 << 63, n + 1).astype(np.uint64)) for _ in range(3000)]
        a, b = (near_dups.signatures(near_dups.sketches(s, 200)) for s in (long, [x[1:] for x in long]))
        apart = np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=1)
        assert (apart <= near_dups.bits_apart(80)).all()
