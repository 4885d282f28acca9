from __future__ import annotations

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakekit.functions import columns as C
from lakekit.functions import money as M
from lakekit.functions import text as T
from lakekit.plans.gold import abc_class
from lakekit.values import TIER_LIMITS, TIER_LOWEST


def one(spark, expression, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    row = tuple(v for _, v in values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(expression.alias("r")).first().r


def test_keys_and_dates(spark):
    assert one(spark, C.pad_key("k"), k=("int", 312)) == "0000000312"
    assert one(spark, C.parse_yyyymmdd("d"), d=("int", 20240131)) == date(2024, 1, 31)
    assert one(spark, C.parse_yyyymmdd("d"), d=("string", "00000000")) is None
    assert one(spark, C.period_label("y", "m"), y=("int", 2024), m=("int", 3)) == "2024-03"


@pytest.mark.parametrize("amount, valid", [(5.0, True), (0.0, False), (-1.0, False), (None, False)])
def test_missing_amounts_are_invalid(spark, amount, valid):
    assert one(spark, C.valid_unless(C.not_positive("a")), a=("double", amount)) is valid


def test_blank_names_are_invalid(spark):
    flags = spark.createDataFrame([("x",), (" ",), ("",), (None,)], "n string").select(
        C.valid_unless(C.is_blank("n")).alias("ok")
    )
    assert [r.ok for r in flags.collect()] == [True, False, False, False]


def test_safe_ratio_by_zero(spark):
    assert one(spark, C.safe_ratio("a", "b"), a=("double", 3.0), b=("double", 0.0)) is None


def test_active_flag(spark):
    assert one(spark, C.active_since("y", 2026), y=("int", 2024)) is True
    assert one(spark, C.active_since("y", 2026), y=("int", 2023)) is False
    assert one(spark, C.active_since("y", 2026), y=("int", None)) is False


def test_mask(spark):
    assert one(spark, C.mask_prefix("n"), n=("string", "Customer 1")) == "Cus***"


def test_class_limits_are_strict(spark):
    amounts = [1_000_000.01, 1_000_000.0, 500_000.01, 500_000.0, 100_000.01, 100_000.0, None]
    df = spark.createDataFrame([(a,) for a in amounts], "a double").select(abc_class(F.col("a")).alias("c"))
    assert [r.c[0] for r in df.collect()] == ["A", "B", "B", "C", "C", "D", "D"]


def test_tier_limits(spark):
    df = spark.createDataFrame([(a,) for a in (600_000.0, 100_000.0, 50_000.0, None)], "a double")
    tiers = [r.t for r in df.select(M.graded(F.col("a"), TIER_LIMITS, TIER_LOWEST).alias("t")).collect()]
    assert tiers == ["PLATINUM", "SILVER", "STANDARD", "STANDARD"]


def test_money_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1.005,), (None,)], "a double")
    r = df.agg(M.total("a").alias("s"), M.mean("a").alias("m")).first()
    assert r.s == 2.01
    assert r.m == 0.18
    ties = spark.createDataFrame([(1.01,), (1.02,)], "a double").agg(M.mean("a").alias("m")).first()
    assert ties.m == 1.02


def test_ratio_rounds_the_true_value(spark):
    part, whole = F.lit("18760644.20").cast("decimal(28,2)"), F.lit("375212884001.00").cast("decimal(28,2)")
    assert spark.range(1).select(M.percent(part, whole).alias("p")).first().p == 0.0
    assert spark.range(1).select(M.percent(part, F.lit(0).cast("decimal(10,2)")).alias("p")).first().p is None


TEXTS = {
    "Pago a proveedor por materiales, factura 90210": "Pago proveedor",
    "Customer receipt": "Factura cliente",
    "Salary posting": "Nómina",
    "Asset acquisition": "Activo fijo",
    "xyz": "Otro",
}


@pytest.mark.parametrize("text, category", TEXTS.items())
def test_categories(spark, text, category):
    from lakekit.operators.enrich import with_category

    df = spark.createDataFrame([(text,)], "t string")
    assert with_category(df, "t").first().categoria == category


def test_sentiment(spark):
    from lakekit.operators.enrich import with_sentiment

    texts = [
        "excelente y rápido",
        "llegó tarde",
        "buena entrega pero con defecto: bien y mal",
        "nada que decir",
    ]
    df = with_sentiment(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    assert [r.sentiment for r in df.collect()] == ["positive", "negative", "mixed", "neutral"]


def test_extract_fields(spark):
    text = "Factura F-2024-00892 de un proveedor por COP 45.800.000 con fecha 20 enero 2024"
    fields = T.extract_fields("t", {"numero_factura": T.INVOICE_NUMBER, "monto": T.AMOUNT, "email": T.EMAIL})
    found = one(spark, fields, t=("string", text))
    assert found.asDict() == {"numero_factura": "F-2024-00892", "monto": "COP 45.800.000", "email": None}


def test_mask_entities(spark):
    text = "NIT 900.123.456-7 tel +57 (300) 123-4567 a@b.co"
    assert one(spark, T.mask_entities("t"), t=("string", text)) == "NIT [TAX_ID] tel [PHONE] [EMAIL]"


def test_longer_patterns_are_masked_first_and_whole(spark):
    secret = "deadbeef1234567890123456abcdefabcdefabcd"
    cases = {
        f"key {secret}.": "key [SECRET].",
        "12345678901234567890": "12345678901234567890",
        "4111111111111111 4111111111111111": "[CARD] [CARD]",
        "write a.b+c@x-y.example.com now": "write [EMAIL] now",
        "l" * 100_000: "l" * 100_000,
        "l" * 100_000 + "@": "l" * 100_000 + "@",
    }
    for text, masked in cases.items():
        assert one(spark, T.mask_entities("t"), t=("string", text)) == masked
    found = one(spark, T.extract_fields("t", {"card": T.CARD_NUMBER, "secret": T.SECRET}), t=("string", secret))
    assert found.asDict() == {"card": None, "secret": secret}


def test_matches_of_any_length_are_masked_whole(spark):
    cases = {
        "mail " + "x" * 500 + "@" + "y" * 300 + ".museumsverein now": "mail [EMAIL] now",
        "a@b.com_x@y.org": "[EMAIL][EMAIL]",
        "a@b.c a@b": "a@b.c a@b",
        "@" * 50_000 + "a.": "@" * 50_000 + "a.",
        "a." * 50_000 + "@" + "b." * 50_000: "a." * 50_000 + "@" + "b." * 50_000,
        "0a" * 200: "[SECRET]",
        "0a" * 15: "0a" * 15,
        "0a" * 40 + "g": "0a" * 40 + "g",
        "+1 212-555-0100, +49 (0)30 901820 and +57 (300) 123-4567": "[PHONE], [PHONE] and [PHONE]",
        "+1" + "(" * 50_000: "+1" + "(" * 50_000,
        "4111 1111 1111 1111 or 3782-822463-10005 or 4222222222222": "[CARD] or [CARD] or [CARD]",
        "1234 5678": "1234 5678",
    }
    for text, masked in cases.items():
        assert one(spark, T.mask_entities("t"), t=("string", text)) == masked


def test_plain_patterns_find_the_same(spark):
    import random
    import re

    rng = random.Random(6)
    pieces = ["a", "b.c", "@", ".", "_", "%", " ", "0a1b", "f" * 20, "de", "-", "x@y.zz"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(600)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern, plain in T.PLAIN.items():
        got = [r[0] for r in df.select(F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).collect()]
        assert got == [re.findall(plain, t) for t in texts]


def test_long_keys_stay_whole(spark):
    for key, padded in ((5, "0000000005"), (10000000001, "10000000001"), (100000000015, "100000000015")):
        assert one(spark, C.pad_key("k"), k=("bigint", key)) == padded


def test_normalise_description(spark):
    assert one(spark, T.normalise_description("t", 3), t=("string", "  cemento   PORTLAND tipo I ")) == (
        "Cemento Portland Tipo"
    )


def test_labelled_text_shows_gaps(spark):
    text = C.labelled_text({"Ciudad": "c", "Órdenes": "n"})
    assert one(spark, text, c=("string", None), n=("int", 3)) == "Ciudad=N/A, Órdenes=3"


def test_rows_helper(spark):
    assert rows(spark.createDataFrame([(2,), (1,)], "a int")) == [(1,), (2,)]
