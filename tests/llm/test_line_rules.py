from __future__ import annotations

import re

import oracle
from hypothesis import given, settings
from hypothesis import strategies as st

from lakekit.llm import catalog, line_rules


def brute_repeats(words, window=5):
    spans = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    return len({p for i, s in enumerate(spans) if spans.count(s) > 1 for p in range(i, i + window)})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=40))
def test_repeat_words(words):
    assert line_rules.repeat_words(words) == brute_repeats(words)


def test_rules_by_line():
    for line in (
        b"### $$$ *** one",
        b"Home | News | Sport | Contact",
        b"READ ALL ABOUT IT NOW",
        b"Buy! now!! it's!! here!!",
        b"1234 -- 5678",
        b"spam " * 20,
        b"We use cookies: see our cookie policy.",
    ):
        assert line_rules.failing(line), line
    for line in (b"A plain sentence of words.", "Größe ist alles, sagt er.".encode(), b"De.", b"1. First of all, a list | item"):
        assert not line_rules.failing(line), line


def test_odd_rows(spark):
    good = "One two three four five six seven eight nine ten eleven.\nA second line that says something else."
    long = " ".join(f"word{i}" for i in range(30000))
    rows = [(1, good, 1), (1, good, 1), (2, None, 1), (3, "", 1), (4, "\n \n", 1), (None, long, 1), (5, "x y " * 50, 1)]
    rows.append((6, good + "\n" + "\n".join(["HOME | A | B | C | D"] * 40), 1))
    out = line_rules.clean_lines(spark.createDataFrame(rows, "doc_id long, text string, n_words int"))
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(rows)
    assert [got[i]["kept"] for i in (1, 2, 3, 4, None, 5, 6)] == [True, False, False, False, True, False, False]
    assert got[2]["cleaned"] == "" and got[2]["n_words"] == 0 and got[2]["base_failed"]
    assert got[6]["cleaned"] == good and got[6]["n_dup_lines"] == 39
    assert got[None]["n_words"] == 30000 and got[None]["n_repeat_words"] == 0
    assert line_rules.clean_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_statistics_against_sql(spark, db, folder):
    df = catalog.QUERIES["op9_line_rules"](spark, folder)
    assert oracle.spark_rows(df.drop("kept")) == oracle.duckdb_rows(db, line_rules.oracle())


def test_clean_documents_stay(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = catalog.QUERIES["op9_line_rules"](spark, folder).join(labels, "doc_id").collect()
    assert all(r["kept"] == bool(r["quality"]) for r in rows if not r["base_failed"])


def test_word_characters_are_code_points():
    stats, *_ = line_rules.clean("né 日本 x\t#".encode())
    assert stats == (3, len(re.sub(r"[\x20\x09-\x0D]", "", "né 日本 x\t#")), 1, 0, 0)


def test_shouting_counts_all_letters():
    assert line_rules.failing(b"BUY DVD BUG LUCKY FULL")
    assert not line_rules.failing(b"HE SAT IN my buggy, full of luck")
