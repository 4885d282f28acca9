from __future__ import annotations

import hashlib

import numpy as np
import oracle
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakekit.llm import catalog, fim


def brute(doc_id, text):
    """The contract, by plain string slices."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5 * fim.CONTAINER), min_size=1, max_size=60), st.integers(1, 30000), st.integers(1, 40))
def test_select_over_all_containers(places, run, step):
    mask = np.zeros(6 * fim.CONTAINER, bool)
    for i, p in enumerate(places):
        mask[p : p + run : step if i % 2 else 1] = True
    offsets = np.flatnonzero(mask)
    held = fim.BoundarySet(mask)
    assert len(held) == len(offsets)
    for k in {0, len(offsets) - 1, *np.linspace(0, len(offsets) - 1, 50).astype(int).tolist()}:
        assert held.select(k) == offsets[k]
    with pytest.raises(IndexError):
        held.select(len(offsets))


def test_containers_take_the_smallest_form():
    sparse, dense, runs = (np.zeros(fim.CONTAINER, bool) for _ in range(3))
    sparse[::97] = True
    dense[np.random.default_rng(1).random(fim.CONTAINER) < 0.5] = True
    runs[100:40000] = True
    forms = [type(fim.BoundarySet(m).containers[0]) for m in (sparse, dense, runs)]
    assert forms == [fim.Array, fim.Bitmap, fim.Runs]


def test_units():
    text = "one  two\nthree äöü\n"
    data = text.encode()
    for unit, starts in (("word", [0, 5, 9, 15]), ("line", [0, 9]), ("code_point", [len(text[:i].encode()) for i in range(len(text))])):
        held = fim.boundaries(data, unit)
        assert [held.select(k) for k in range(len(held))] == [*starts, len(data)]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.text(st.sampled_from("ab<PSM>é漢😀\n"), max_size=30))
def test_one_text(doc_id, text):
    marks = (b"<P>", b"<S>", b"<M>")
    got = fim.cut(text.encode(), str(doc_id), "code_point", "1:", marks)
    assert (*got[:4], got[4].decode()) == brute(doc_id, text)


def test_odd_rows(spark):
    mixed = "ab é 漢字 😀\n" * 30000  # several containers, more than one form
    texts = [None, "", "a", "<", "<<S", "has <M> mark", mixed, "plain ascii " * 20000, "x\u0000y", "é"]
    rows = [(i * len(texts) + j, t, -1) for i in range(12) for j, t in enumerate(texts)] + [(None, "no id", 1), (3, "again", 1), (3, "again", 1)]
    cuts = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string, n long"))
    got = sorted((tuple(r) for r in cuts.collect()), key=repr)
    assert got == sorted(((i, *brute(i, t)) for i, t, _ in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    hashed = fim.digests(cuts).collect()
    want = sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, _ in rows)
    assert sorted(r["restored_sha256"] for r in hashed) == want
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id string, text string")).count() == 0


def test_words_come_back(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i))) for i in range(200)]
    cuts = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), unit="word")
    back = cuts.select("doc_id", fim.restored(cuts["form"], cuts["output"]).alias("text"), "n")
    assert sorted(tuple(r) for r in back.collect()) == [(i, t, i) for i, t in rows]


def test_same_rows_as_sql(spark, db, folder):
    got = oracle.spark_rows(catalog.QUERIES["op12_boundary_set"](spark, folder))
    assert got == oracle.duckdb_rows(db, catalog.ORACLES["op12_boundary_set"])
