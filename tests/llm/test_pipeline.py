from __future__ import annotations

import re

import corpus_pipeline as cp
from test_decontaminate import brute as hits
from test_mixing import wanted as mix_wanted
from test_near_dups import brute as linked
from test_pii import brute as personal

from lakekit.llm import catalog


def rows_of(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_each_stage_against_its_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    predicted = {r["doc_id"]: r["predicted"] for r in catalog.QUERIES["op7_quality_discriminant"](spark, folder).collect()}
    stages = dict(cp.STAGES)
    assert list(stages) == ["quality", "near_dedup", "decontamination", "pii", "mixing"]

    good = stages["quality"](spark, docs, folder)
    assert good.columns == columns
    kept = rows_of(good)
    assert kept == {i: r for i, r in rows_of(docs).items() if predicted[i]}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(i in kept for i, q in labels.items() if q == 1)

    single = stages["near_dedup"](spark, good.orderBy("doc_id"), folder)
    first = {r[0] for r in linked([(i, r["text"]) for i, r in kept.items()], 5) if r[3]}
    assert single.columns == columns and rows_of(single) == {i: r for i, r in kept.items() if i in first}

    clean = stages["decontamination"](spark, single, folder)
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    before, after = rows_of(single), rows_of(clean)
    assert clean.columns == columns
    for i, r in before.items():
        words, hit, _ = hits(r["text"], items)
        assert (i in after) == (not hit or len(hit) <= 0.5 * len(words))
        if not hit:
            assert after[i] == r
        elif i in after:
            own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", after[i]["text"].lower())
            assert len(own) == len(words) - len(hit)

    masked = stages["pii"](spark, clean, folder)
    assert masked.columns == columns
    for i, r in rows_of(masked).items():
        assert not personal(r["text"])
        if not personal(after[i]["text"]) and r["text"] != after[i]["text"]:
            assert "[SECRET]" in r["text"] or "[PERSON]" in r["text"] or "[PHONE]" in r["text"]

    mixed = stages["mixing"](spark, masked, folder).collect()
    inputs = [(r["doc_id"], r["text"], r["source"]) for r in rows_of(masked).values()]
    sizes, total, target = mix_wanted(inputs)
    by_id = dict(zip((i for i, *_ in inputs), sizes))
    taken = dict.fromkeys(target, 0)
    for r in mixed:
        assert 0 < r["copies"] <= 2 and r["size"] == by_id[r["doc_id"]] and r["taken"] == r["size"] * r["copies"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= max(sizes) for s in target)


def test_stages_with_odd_rows(spark, folder):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "a", 0, 1), (1, "", "en", "a", 0, 1), (2, "w " * 60_000, "en", "b", 0, 1)]
    rows += [(i, f"A plain text number {i} of a few good words for all of us to read.", "en", "a", 9, i) for i in (3, 3, 4)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in cp.STAGES:
            out = stage(spark, docs, folder)
            out.collect()
            if name != "mixing":
                assert out.columns == docs.columns


def test_run_takes_the_whole_table(spark, folder):
    assert cp.run(spark, folder).count() > 50
