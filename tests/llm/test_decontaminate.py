from __future__ import annotations

import hashlib
import random
import re

import oracle
from hypothesis import given, settings
from hypothesis import strategies as st

from lakekit.llm import catalog, decontaminate


def brute(text, items, window=10):
    """(words, hit positions, items) by comparing every window with every item."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    hit, found = set(), set()
    for name, item in items:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in item or "")
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        n = min(window, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(name)
    return words, hit, found


WORDS = st.lists(st.sampled_from(["a", "b", "c"]), max_size=30).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(WORDS, max_size=5), WORDS, st.integers(2, 6))
def test_automaton_finds_all_windows(items, text, window):
    named = [(str(i), t) for i, t in enumerate(items)]
    automaton = decontaminate.SuffixAutomaton([(n, decontaminate.words_of(t.encode())) for n, t in named], window)
    ranges, found = automaton.matches(decontaminate.words_of(text.encode()))
    _, hit, names = brute(text, named, window)
    assert {p for a, b in ranges for p in range(a, b)} == hit
    assert found == names


def documents(spark):
    rng = random.Random(3)
    item = " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(40))
    items = [(1, item), (10, "Short, ITEM here"), (2, None), (2, ""), (None, item[30:90]), (1, item)]
    texts = [None, "", "no hit", "x " + item.upper() + " y", "a Short item; here, b", "größe " * 3, item[:55] + " z" * 30000]
    docs = [(i, t, "c", 5) for i, t in enumerate(texts)] + [(3, texts[3], "c", 5)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, _words string, n_hit int"),
        spark.createDataFrame(items, "item_id long, text string"),
        docs,
        [("" if n is None else str(n), t) for n, t in items],
    )


def expected(docs, items):
    out = []
    for i, text, *_ in docs:
        words, hit, found = brute(text, items)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out)


def test_hits_with_odd_rows(spark):
    df, items, docs, named = documents(spark)
    for block in (200_000, 10):
        matched = decontaminate.match_items(df, items, block_words=block)
        assert sorted(map(tuple, decontaminate.hit_counts(matched).collect())) == expected(docs, named)


def test_empty_tables(spark):
    df, items, docs, _ = documents(spark)
    none = decontaminate.hit_counts(decontaminate.match_items(df, items.limit(0))).collect()
    assert len(none) == len(docs) and not any(r["contaminated"] for r in none)
    assert decontaminate.match_items(df.limit(0), items).count() == 0


def test_spans_are_cut_and_covered_documents_go(spark):
    df, items, *_ = documents(spark)
    out = decontaminate.remove_contamination(df, items)
    assert out.columns == df.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert set(texts) == {0, 1, 2, 5, 6}
    assert texts[0] is None and texts[2] == "no hit"
    assert texts[6].endswith(" z z") and len(texts[6]) >= 60000
    assert decontaminate.match_items(out, items).where("size(_ranges) > 0").count() == 0


def test_query_against_sql_and_brute_force(spark, db, folder):
    df = catalog.QUERIES["op8_suffix_automaton"](spark, folder)
    assert oracle.spark_rows(df) == oracle.duckdb_rows(db, catalog.ORACLES["op8_suffix_automaton"])
    assert df.where("contaminated").count() > 0
