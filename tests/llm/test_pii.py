from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakekit.llm import catalog, pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(b[0] == k for b in base) for k in PLAIN]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        spans = [tuple(x.split(":")) for x in r["spans"].split(",") if x]
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), int(s[1])))
        assert {(k, str(a), str(b)) for k, a, b in base} <= set(spans)


PIECES = ["a", "é", "😀", "@", ".", "-", "+", " ", "(", ")", "1", "255", "300", "4111111111111111", "x.y", "0", "\n", "_%"]


@pytest.fixture(scope="module")
def random_texts():
    rng = random.Random(4)
    return {i: "".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for i in range(1500)}


def test_base_spans_of_random_texts(spark, random_texts):
    df = spark.createDataFrame(list(random_texts.items()), "doc_id long, text string")
    check(pii.summarise(pii.find_spans(df)).collect(), random_texts)


def odd_texts(n):
    return {
        1: None, 2: "", 3: "a" * n, 4: "1" * n, 5: "a@" + "b." * n, 6: "1 " * n + "x", 7: "a@b.c_d@e.f", 8: "+" * n,
        9: "+1" + "(" * n, 10: "é😀 me@x.org +1 (212) 555-0100 10.0.0.255", 11: "1.2.3.4.5.6.7.8", 12: "1." * n,
    }


def test_odd_rows(spark):
    texts = odd_texts(500)
    df = spark.createDataFrame([(i, t, "clash") for i, t in texts.items()], "doc_id long, text string, kind string")
    check(pii.summarise(pii.find_spans(df)).collect(), texts)
    again = spark.createDataFrame([(10, texts[10]), (10, texts[10]), (None, "x y")], "doc_id long, text string")
    assert sorted(r["n_email"] for r in pii.summarise(pii.find_spans(again)).collect()) == [0, 1, 1]
    assert pii.summarise(pii.find_spans(df.limit(0))).count() == 0


def test_long_runs_take_linear_time(spark):
    df = spark.createDataFrame(list(odd_texts(100_000).items()), "doc_id long, text string")
    start = time.time()
    got = {r["doc_id"]: r["n_ip"] for r in pii.summarise(pii.find_spans(df)).collect()}
    assert got[12] == 25_000 and time.time() - start < 60


def test_method_adds_spans_with_context_and_keeps_plain_text(spark):
    rows = [(i, f"Please call us: (212) 555-01{i:02d} or mail me at jane{i} [at] site.org") for i in range(30)]
    rows += [(100 + i, f"auth token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\"") for i in range(30)]
    rows += [(200 + i, f"mail a{i}@b.com, phone +1 (212) 555-0{i:03d}, host 10.1.2.{i}") for i in range(30)]
    rows += [(300, "Version 1.2.3.444 costs 12 of 1234567890123456, checksum")]
    got = {r["doc_id"]: r["spans"] for r in pii.summarise(pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all("phone" in got[i] and "email" in got[i] for i in range(30))
    assert all(got[100 + i].startswith("secret:14:54") for i in range(30))
    assert got[300] == ""


def test_em_finds_the_reliable_labelers():
    rng = random.Random(1)
    counts = {}
    for _ in range(4000):
        y = rng.random() < 0.5
        good = [1 if y else -1 if rng.random() < 0.5 else 0 for _ in range(3)]
        votes = (good[0], rng.choice((-1, 0, 1)), good[1], good[2], rng.choice((-1, 0, 1)))
        counts["phone", votes] = counts.get(("phone", votes), 0) + 1
    _, rates, belief = pii.estimate(counts)
    assert rates["shape"][1, 2] > 0.9 and abs(rates["gazetteer"][1, 2] - rates["gazetteer"][0, 2]) < 0.25
    model = pii.train(counts)
    for (kind, votes), p in belief.items():
        assert abs(model.score(kind, votes) - p) < 0.25
    assert pii.train({}).weights == {}


@pytest.mark.parametrize("size", [2000, 20_000, 200_000])
@pytest.mark.parametrize("random_one", range(5))
def test_em_tells_good_labelers_from_a_random_one(size, random_one):
    rng = random.Random(size + random_one)
    counts = {}
    for _ in range(size // 10):
        y = rng.choice((-1, 1))
        votes = tuple(rng.choice((-1, 1)) if j == random_one else y if rng.random() < 0.95 else -y for j in range(5))
        counts["phone", votes] = counts.get(("phone", votes), 0) + 10
    _, rates, _ = pii.estimate(counts)
    for j, name in enumerate(pii.LABELERS):
        right = rates[name][1, 2], rates[name][0, 0]
        if j == random_one:
            assert max(abs(r - 0.5) for r in right) < 0.1
        else:
            assert min(right) > 0.9


def test_copies_are_one_witness(spark):
    rows = [(i, f"host 10.1.2.{i}, card 4111 1111 1111 1111") for i in range(20)]
    copies = rows + [(100 + i, "serial 1234 5678") for i in range(300)]
    few = rows + [(100, "serial 1234 5678")]
    both = [pii.summarise(pii.find_spans(spark.createDataFrame(x, "doc_id long, text string"))) for x in (copies, few)]
    shown = [{(r["doc_id"], r["spans"]) for r in b.where("doc_id < 100").collect()} for b in both]
    assert shown[0] == shown[1] and len(shown[0]) == 20


def test_long_proposals_stay_whole(spark):
    long = {1: "token " + "0a" * 90, 2: "mail " + "m" * 90 + " [at] site [dot] org", 3: "key ab_" + "X9" * 60, 4: "Dear Mr Q" + "z" * 50 + " Smith"}
    got = pii.proposals(spark.createDataFrame(list(long.items()), "doc_id long, text string"), "doc_id", "text")
    found = {r["doc_id"]: r["match"] for r in got.where("not base").collect()}
    assert found == {1: "0a" * 90, 2: "m" * 90 + " [at] site [dot] org", 3: "ab_" + "X9" * 60, 4: "Mr Q" + "z" * 50 + " Smith"}


def test_masking(spark):
    text = "Mail bob@x.org, é +1 (212) 555-0100."
    rows = [(1, text, 5), (1, text, 6), (2, None, 7), (3, "plain", 8), (None, text, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind int")
    got = pii.mask(df)
    assert got.columns == df.columns
    wanted = "Mail [EMAIL], é [PHONE]."
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, wanted, 5), (1, wanted, 6), (2, None, 7), (3, "plain", 8), (None, wanted, 9)], key=repr)


def test_query_against_brute_force(spark, folder):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    check(catalog.QUERIES["op1_weak_supervision"](spark, folder).collect(), texts)


@settings(max_examples=100, deadline=None)
@given(st.text("0123456789", min_size=1, max_size=19))
def test_luhn_by_hand(digits):
    assert luhn(digits) == (sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0)
