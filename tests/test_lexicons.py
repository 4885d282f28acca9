from __future__ import annotations

import random

import pytest
from conftest import executed_plan, rows
from pyspark.sql import functions as F

from lakekit.operators import joins, lexicons


@pytest.fixture(scope="module")
def lexicon(spark):
    """Four thousand terms, some of them in two categories."""
    made = [(f"w{chr(97 + i % 26)}{'x' * (i // 26)}", f"c{i % 5}", i % 7) for i in range(4000)]
    return spark.createDataFrame(made + [("both", "c1", 3), ("both", "c0", 3)], "term string, label string, weight long")


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_LIMIT])
def test_categories_against_plain_counts(spark, lexicon, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_LIMIT", limit)
    rng = random.Random(1)
    table = {}
    for term, label, weight in lexicon.collect():
        table.setdefault(term, []).append((label, weight))
    terms = sorted(table)
    texts = [(i, " ".join(rng.choice([*rng.sample(terms, 3), "the", "the"]).upper() for _ in range(rng.randrange(30)))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, "nothing known"), (103, "both"), (104, "BOTH, both!")]

    def brute(text):
        scores = {}
        for w in text.lower().replace(",", " ").replace("!", " ").split():
            for label, weight in table.get(w, ()):
                scores[label] = scores.get(label, 0) + weight
        best = min(((-s, label) for label, s in scores.items()), default=(0, ""))
        return best[1] if best[0] < 0 else "Otro"

    got = lexicons.categorise(spark.createDataFrame(texts, "id long, t string"), "id", "t", lexicon)
    assert rows(got) == sorted(((i, brute(t)) for i, t in texts if t), key=repr)
    plan = executed_plan(got)
    assert " IN (" not in plan and "INSET" not in plan


def test_negation_turns_the_words_after_it(spark):
    lexicon = spark.createDataFrame([("good", 2), ("fine", 1), ("bad", -2)], "term string, weight long")
    negators = spark.createDataFrame([("not",), ("never",)], "term string")
    cases = {
        "good": (2, 0, "positive"),
        "not good": (0, 2, "negative"),
        "not a really good one": (0, 2, "negative"),
        "not one of the good ones": (2, 0, "positive"),  # too far away
        "good, not": (2, 0, "positive"),
        "not never good": (0, 2, "negative"),
        "not bad": (2, 0, "positive"),
        "good fine bad": (3, 2, "mixed"),
        "fine fine bad bad": (2, 4, "negative"),
        "nothing": (0, 0, "neutral"),
        "": (0, 0, "neutral"),
        None: (0, 0, "neutral"),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "id long, t string")
    scores = lexicons.sentiment_scores(df, "id", "t", lexicon, negators)
    got = scores.withColumn("s", lexicons.sentiment_label(F.col("positive"), F.col("negative")))
    assert [tuple(r)[1:] for r in got.orderBy("id").collect()] == list(cases.values())
    assert lexicons.sentiment_scores(df.limit(0), "id", "t", lexicon, negators).count() == 0


def test_lexicons_from_texts(spark):
    made = [(i, "alle guten dinge" if i % 2 else "all good things", "de" if i % 2 else "en", i % 2) for i in range(10)]
    df = spark.createDataFrame([*made, (50, "all rare", "en", None), (51, "alle", None, 0)], "id long, t string, lang string, q int")
    frequent = lexicons.frequent_terms(df, "id", "t", "lang", 2)
    assert rows(frequent) == sorted([("alle", "de", 1000), ("dinge", "de", 1000), ("all", "en", 1000), ("good", "en", 833)], key=repr)
    opposed = {r.term: r.weight for r in lexicons.opposed_terms(df, "id", "t", F.col("q") == 1, 2).collect()}
    assert opposed == {"guten": 2, "dinge": 2, "alle": 2, "all": -2, "good": -2, "things": -2}
