from __future__ import annotations

import hashlib
import re

import duckdb
import oracle
import pytest

from lakekit.llm import catalog, mixing

SCHEMA = "doc_id long, text string, source string, taken string, size int"


def wanted(rows, cap=2.0, share=1.5):
    """The contract by hand: reshare until no target is above its cap, then the smallest hashes first."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total = {s: sum(n for n, r in zip(sizes, rows) if r[2] == s) for s in names}
    target, free, left = {}, set(names), share * sum(sizes)
    while free:
        each = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * each > cap * total[s]}
        if not over:
            target |= {s: weight[s] * each for s in free}
            break
        for s in over:
            target[s] = cap * total[s]
            left -= target[s]
        free -= over
    return sizes, total, target


def check(spark, rows, max_error_words):
    df = spark.createDataFrame([(i, t, s, "clash", 7) for i, t, s in rows], SCHEMA)
    out = mixing.mix_sources(df).collect()
    assert len(out) == len(rows)
    sizes, total, target = wanted(rows)
    assert sorted(r["size"] for r in out) == sorted(sizes)
    source = {i: s for i, _, s in rows}
    taken = {}
    for r in out:
        s = source[r["doc_id"]]
        assert r["source_size"] == total[s]
        assert r["target"] == pytest.approx(target[s])
        assert r["taken"] <= 2 * r["size"]
        assert r["size"] == 0 or r["taken"] % r["size"] == 0
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in target:
        assert abs(taken[s] - target[s]) <= max_error_words
    return out


def test_targets_and_takes(spark):
    rows = [(i, "w " * (1 + i % 7), ("a", "b", "c", None, "ü")[i % 5 if i % 3 else 0]) for i in range(400)]
    first = check(spark, rows, 7)
    assert sorted(first) == sorted(mixing.mix_sources(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect())


def test_nulls_empty_and_repeated_rows(spark):
    rows = [(None, None, None), (1, "", "a"), (2, "x y z", "a"), (2, "x y z", "a"), (3, "w " * 5000, "b")]
    check(spark, rows, 5000)


def test_only_empty_texts(spark):
    out = mixing.mix_sources(spark.createDataFrame([(1, "", "a", "", 0), (2, None, None, "", 0)], SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in out] == [(0, 0.0, 0)] * 2


def test_empty_table(spark):
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_sql(spark, db, folder):
    got = oracle.spark_rows(catalog.QUERIES["op4_mix_sources"](spark, folder))
    assert got == oracle.duckdb_rows(db, catalog.ORACLES["op4_mix_sources"])


def test_hash_is_md5(spark):
    row = spark.range(5, 6).select(mixing.document_hash(mixing.F.col("id"), "mix:").alias("h")).first()
    assert row["h"] == int(hashlib.md5(b"mix:5").hexdigest()[:15], 16)
    assert duckdb.sql("SELECT ('0x' || md5('mix:5')[1:15])::BIGINT").fetchall()[0][0] == row["h"]
