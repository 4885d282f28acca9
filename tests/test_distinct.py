from __future__ import annotations

import random
from datetime import date

import pytest
from conftest import executed_plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.operators import distinct
from lakekit.operators.cleaning import distinct_profile
from lakekit.operators.partials import PartialTable
from lakekit.plans import gold

ODD = ["", "1", "01", "001", "0001", "00001", "12345", "x2345", "2345", "1:4", ":4", "é1234", "１２３４", "12 34", " 1234", "12345:0", "a" * 50]


@pytest.mark.parametrize("kind", ["string", "long", "int"])
def test_counts_equal_count_distinct(spark, kind):
    rng = random.Random(4)
    if kind == "string":
        values = [*ODD, None, *(f"{i:010d}" for i in range(0, 200_000, 997))]
    else:
        values = [None, 0, -1, 1, 32767, 32768, -32768, -32769, 2**31 - 1, -(2**31), *range(0, 500_000, 1009)]
        values += [2**62, -(2**62)] if kind == "long" else []
    made = [(rng.choice(["a", "b", None]), rng.choice(values)) for _ in range(3000)] + [("empty", None)]
    df = spark.createDataFrame(made, f"g string, v {kind}").repartition(4)
    want = df.groupBy("g").agg(F.count_distinct("v").alias("n"))
    assert rows(distinct.count_numbered(df, ["g"], "v", "n")) == rows(want)
    assert rows(distinct.count_numbered(df, [], "v", "n")) == rows(df.agg(F.count_distinct("v")))


def test_bitmaps_of_batches_add_up(spark, tmp_path):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("g", "_bucket")] + [T.StructField("bits", T.BinaryType())])
    table = PartialTable(str(tmp_path), schema, ["g", "_bucket"], {"bits": F.bitmap_or_agg}, fan=2)
    batches = [spark.range(a, a + 60_000, 7).selectExpr("lpad(id, 10, '0') AS v", "string(id % 3) AS g") for a in (0, 30_000, 1_000_000)]
    for i, batch in enumerate(batches):
        table.add(distinct.distinct_bits(batch, ["g"], "v"), i)
    every = batches[0].union(batches[1]).union(batches[2])
    counted = table.read(spark).groupBy("g").agg(distinct.number_of_bits().alias("n"))
    assert rows(counted) == rows(every.groupBy("g").agg(F.count_distinct("v")))
    merged = distinct.merge_bits(batches[0].transform(distinct.distinct_bits, ["g"], "v"), ["g"])
    assert merged.count() == table.read(spark, after=0).count()


def orders(spark, n):
    rng = random.Random(n)
    made = [
        (rng.choice([f"{i:010d}", "dup"]), date(2024, 1 + i % 12, 3), rng.choice(["0000000007", f"{i % 99:010d}", None]), rng.choice(["a", None]), rng.choice(["USD", None]), rng.choice([1.25, 10.0, -1.0, None]))
        for i in range(n)
    ]
    return spark.createDataFrame(made, "VBELN string, ERDAT date, KUNNR string, VKORG string, WAERK string, NETWR double")


@pytest.mark.parametrize("n", [0, 1, 800])
def test_reports_need_no_copies_of_rows(spark, n):
    df = orders(spark, n)
    usable = df.where("NETWR > 0 AND VBELN IS NOT NULL").groupBy(F.year("ERDAT"), F.month("ERDAT"), "VKORG", "WAERK")
    want = usable.agg(F.count_distinct("VBELN").alias("o"), F.count_distinct("KUNNR").alias("c"), F.sum(F.col("NETWR").cast("decimal(18,2)")).cast("double"))
    kpis = gold.sales_kpis_monthly(df)
    got = kpis.select("year", "month", "sales_org", "currency", "num_orders", "num_customers", "total_revenue")
    assert rows(got) == rows(want)
    named = df.select(F.col("VBELN").alias("numero_orden"), F.col("KUNNR").alias("codigo_cliente"), F.col("NETWR").alias("valor_neto"), (F.col("NETWR") < 0).alias("es_devolucion"))
    executive = gold.executive_kpis(named)
    want = named.agg(F.count_distinct("numero_orden"), F.count_distinct("codigo_cliente"), F.count_if("es_devolucion"))
    assert rows(executive.select("total_ordenes", "clientes_activos", "devoluciones")) == rows(want)
    profile = distinct_profile(df, "WAERK", "KUNNR", "ERDAT", numbered=["KUNNR"])
    assert rows(profile) == rows(df.agg(F.count("*"), *[F.count_distinct(c) for c in ("WAERK", "KUNNR", "ERDAT")]))
    for result in (kpis, executive, profile):
        assert "Expand" not in executed_plan(result)
