from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakekit.llm import catalog, packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_vocabulary())


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


ODD = ["<|endoftext|>", "a<|startoftext|>b", "it's we'LL I'd", "ΣΑΣ Σ", "é ́x", "a b c\u0085d\u001ce", "İstanbul", "漢字かな", "9876", "한글", "?!.."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*ODD, " ", "\n", "\t \r", "\x0b", "the", "word", "<|", "|>", "'", "s"]), max_size=30))
def test_same_ids_as_the_tokenizer(tokenizer, pieces):
    text = "".join(pieces)
    data = text.encode()
    encoder = packing.encoder(packing.default_vocabulary())
    assert encoder.by_words
    assert np.frombuffer(encoder.encode(data), "<u4").tolist() == plain(tokenizer, text)[:-1]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_same_ids_for_any_text(tokenizer, text):
    encoder = packing.encoder(packing.default_vocabulary())
    assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == plain(tokenizer, text)[:-1]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=255), max_size=60))
def test_same_ids_for_latin(tokenizer, text):
    encoder = packing.encoder(packing.default_vocabulary())
    assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == plain(tokenizer, text)[:-1]


def test_words_are_forgotten_and_found_again(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    encoder = packing.Encoder(packing.default_vocabulary())
    text = " ".join(f"w{i % 37} x{i % 5}" for i in range(400))
    assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == plain(tokenizer, text)[:-1]
    assert len(encoder.known) + len(encoder.known.older) <= 10


def test_other_tokenizers_read_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "Two  words,\n and more " * 20
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.encoder(path).encode(text.encode()), "<u4").tolist() == want


def test_parts():
    text = b"ab cd\n" * 50 + b"x" * 100 + b" y"
    got = list(packing.parts(text, 20))
    assert b"".join(got) == text
    assert max(len(p) for p in got) > 100 and sum(len(p) > 20 for p in got) == 1
    assert list(packing.parts(b"z" * 50, 20)) == [b"z" * 50] and list(packing.parts(b"", 20)) == [b""]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 20000), st.sampled_from([1, 7, 64, 4096]))
def test_windows_follow_each_other(total, size):
    at = sequence = 0
    while at < total:
        number, offset, end = packing.windows(at, total, size)
        assert (number, offset) == (sequence, 0) and at < end <= min(total, at + size)
        assert end - at == size or (end - at).bit_count() == 1
        assert packing.windows(end - 1, total, size) == (sequence, end - 1 - at, end)
        at, sequence = end, sequence + 1


def check(tokenizer, rows, pieces, size):
    """Pieces against ids of the tokenizer itself; returns the padding."""
    left = {}
    for doc_id, text in rows:
        left.setdefault(doc_id, []).append(plain(tokenizer, text))
    ids = {}
    found = {}
    for p in pieces:
        data = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(data) == p["length"] > 0
        assert any(data == d[p["start"] : p["start"] + p["length"]] and len(d) == p["doc_tokens"] for d in left[p["doc_id"]])
        found.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        for k in range(p["start"], p["start"] + p["length"]):
            ids[p["doc_id"], k] = ids.get((p["doc_id"], k), 0) + 1
    for doc_id, all_ids in left.items():
        for k in range(max(map(len, all_ids))):
            assert ids[doc_id, k] == sum(k < len(d) for d in all_ids)
    padding = 0
    assert sorted(found) == list(range(len(found)))
    for spans in found.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
        padding += 0 if at.bit_count() == 1 else size - at
    return padding


def test_odd_rows(spark, tokenizer):
    long = " ".join(f"word{i} {i * i}" for i in range(20000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, " ".join(ODD)), (5, long), (5, long), (None, "no id"), (6, "x" * 10000), (7, "end")]
    docs = spark.createDataFrame([(i, t, 9, "e") for i, t in rows], "doc_id long, text string, start long, ids string").repartition(3)
    pieces = packing.pack(docs, size=512)
    assert check(tokenizer, rows, pieces.collect(), 512) == 0
    whole = packing.sequences(pieces).collect()
    assert all(len(s["ids"]) == 4 * s["length"] == 4 * sum(b["length"] for b in s["boundaries"]) for s in whole)
    assert packing.pack(spark.createDataFrame([], "doc_id string, text string")).count() == 0


def test_long_documents_take_several_rows(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "ROW_TOKENS", 1000)
    monkeypatch.setattr(packing, "PART_BYTES", 3000)
    rows = [(i, " ".join(f"{i}w{j}" for j in range(i * 37))) for i in range(30)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), size=256).collect()
    assert check(tokenizer, rows, pieces, 256) == 0


def test_registered_query(spark, db, folder, tokenizer):
    rows = db.execute("SELECT doc_id, text FROM documents").fetchall()
    texts = {doc_id: plain(tokenizer, text) for doc_id, text in rows}
    got = catalog.QUERIES["op11_concat_cut"](spark, folder).collect()
    for p in got:
        data = np.array(texts[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4").tobytes()
        assert zlib.crc32(data) == p["ids_crc32"] and p["doc_tokens"] == len(texts[p["doc_id"]])
    assert sum(p["length"] for p in got) == sum(map(len, texts.values()))
    spans = sorted((p["sequence_id"], p["offset"], p["length"]) for p in got)
    for (s, o, n), (t, q, _) in zip(spans, spans[1:], strict=False):
        assert (t, q) in ((s, o + n), (s + 1, 0))
