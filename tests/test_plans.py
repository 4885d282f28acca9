"""Reports on literal rows, and the physical plans they must have."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import executed_plan, rows
from pyspark.sql import functions as F

from lakekit.operators import joins, layout, publish
from lakekit.plans import finance, gold, silver, trends, usage
from lakekit.schemas import BUDGET_SCHEMA, FX_SCHEMA
from lakekit.sources import erp

KPI = "year int, month int, sales_org string, currency string, num_orders bigint, total_revenue double"


def test_budget_status_limits(spark):
    budget = spark.createDataFrame(
        [(2024, m, "1000", "COP", 1000.0, 5, 200.0, "BASE") for m in range(1, 7)], BUDGET_SCHEMA
    )
    revenue = (1000.0, 999.99, 900.0, 899.99, 750.0, 749.99)
    actual = spark.createDataFrame([(2024, i + 1, "1000", "COP", 5, r) for i, r in enumerate(revenue)], KPI)
    status = [r.estado for r in finance.actual_vs_budget(actual, budget).orderBy("month").collect()]
    assert status == ["CUMPLE", "CERCA (>90%)", "CERCA (>90%)", "GAP MODERADO", "GAP MODERADO", "GAP CRITICO"]


def test_missing_rate_or_currency_is_null(spark):
    rates = spark.createDataFrame([(2024, 1, 4000.0, 4400.0, "b", "p")], FX_SCHEMA)
    actual = spark.createDataFrame(
        [(2024, 1, "1000", c, 1, 10.0) for c in ("COP", "USD", "EUR", "MXN")] + [(2024, 2, "1000", "USD", 1, 10.0)], KPI
    )
    local = {(r.month, r.currency): r.ventas_cop for r in finance.revenue_normalised(actual, rates).collect()}
    assert local == {(1, "COP"): 10.0, (1, "USD"): 40000.0, (1, "EUR"): 44000.0, (1, "MXN"): None, (2, "USD"): None}


ORDER = "VBELN string, ERDAT date, KUNNR string, VKORG string, VTWEG string, SPART string, NETWR double, WAERK string, AUART string"


def sales(spark, entries):
    return spark.createDataFrame(
        [(f"{i:010d}", day, customer, "1000", "10", "01", amount, "COP", kind) for i, (day, customer, amount, kind) in enumerate(entries)],
        ORDER,
    )


@pytest.fixture
def orders(spark):
    return sales(
        spark,
        [
            (date(2023, 1, 5), "0000000001", 600_000.0, "ZOR"),
            (date(2023, 3, 5), "0000000001", 500_000.0, "RE"),
            (date(2024, 1, 5), "0000000002", 60_000.0, "OR"),
            (date(2024, 2, 5), "0000000003", 10.0, "CR"),
            (date(2024, 2, 6), "0000000009", 10.0, "OR"),
        ],
    )


@pytest.fixture
def customers(spark):
    return silver.customers_silver(
        spark.createDataFrame(
            [(f"{i:010d}", f" C{i} ", "co", "Cali", "A", "KUNA") for i in range(1, 5)] + [(None, "x", "co", "y", "A", "K")],
            "KUNNR string, NAME1 string, LAND1 string, ORT01 string, BRSCH string, KTOKD string",
        )
    )


def test_customer_gold_fills_zeros(customers, orders):
    found = {r.codigo_cliente: r for r in gold.customers_gold(customers, orders, 2025).collect()}
    assert len(found) == 4
    top, idle = found["0000000001"], found["0000000004"]
    assert (top.total_ordenes, top.revenue_total, top.total_devoluciones) == (2, 1_100_000.0, 1)
    assert (top.clasificacion_abc, top.es_cliente_activo, top.anios_activo) == ("A - Strategic", True, 1)
    assert (idle.total_ordenes, idle.revenue_total, idle.ultimo_anio_compra) == (0, 0.0, None)
    assert (idle.clasificacion_abc, idle.es_cliente_activo) == ("D - Small", False)


def test_customer_360_keeps_customers_without_orders(customers, orders):
    found = {r.customer_id: r for r in gold.customer_360(customers, orders).collect()}
    assert found["0000000001"].customer_tier == "PLATINUM"
    assert found["0000000001"].customer_lifetime_days == 59
    assert found["0000000002"].customer_tier == "SILVER"
    assert (found["0000000004"].total_orders, found["0000000004"].total_revenue) == (0, None)
    assert found["0000000004"].customer_tier == "STANDARD"


def test_abc_keeps_customers_without_master(orders, spark):
    master = spark.createDataFrame([("0000000001", "n", "CO", "c")], "KUNNR string, NAME1 string, LAND1 string, ORT01 string")
    found = {r.KUNNR: r.nombre_cliente for r in gold.customer_abc(orders, master).collect()}
    assert found["0000000009"] is None and len(found) == 4


def test_two_readings_of_best_in_year(customers, orders):
    gold_orders = gold.orders_gold(orders, ("RE", "CR"))
    assert [r.codigo_cliente for r in gold.top_customers_in_year(gold_orders, 2023).collect()] == ["0000000001"]
    in_gold = gold.customers_gold(customers, orders, 2025)
    assert [r.codigo_cliente for r in gold.last_year_equals(in_gold, 2024).collect()] == ["0000000002", "0000000003"]


def test_return_types_are_a_parameter(orders):
    assert gold.orders_gold(orders).where("es_devolucion").count() == 2
    assert gold.orders_gold(orders, ("RE", "RK")).where("es_devolucion").count() == 1


def test_trend_of_a_gap_year(spark):
    df = sales(spark, [(date(2023, 12, 1), "1", 100.0, "OR"), (date(2024, 1, 1), "1", 150.0, "OR"), (date(2024, 2, 1), "1", 75.0, "OR")])
    trend = [
        (r.ventas_mes_anterior, r.variacion_pct, r.ventas_ytd) for r in trends.monthly_trend(df).orderBy("anio", "mes").collect()
    ]
    assert trend == [(None, None, 100.0), (100.0, 50.0, 150.0), (150.0, -50.0, 225.0)]


def test_calendar_of_features_is_dense(spark):
    df = sales(spark, [(date(2023, 11, 1), "1", 100.0, "OR"), (date(2024, 2, 1), "1", 40.0, "OR")])
    found = trends.forecast_features(df).orderBy("month").collect()
    assert [r.sales for r in found] == [100.0, 0.0, 0.0, 40.0]
    assert [r.lag_3 for r in found] == [None, None, None, 100.0]
    assert [r.month_index for r in found] == [0, 1, 2, 3]


def test_price_is_the_one_of_the_time(spark):
    at = datetime(2024, 1, 10)
    use = spark.createDataFrame(
        [(date(2024, 1, 9), datetime(2024, 1, 9), "s", "p", 2.0), (date(2024, 1, 10), at, "s", "p", 3.0)],
        "usage_date date, usage_start_time timestamp_ntz, sku_name string, billing_origin_product string, usage_quantity double",
    )
    prices = spark.createDataFrame(
        [("s", datetime(2023, 1, 1), at, (1.0,)), ("s", at, None, (10.0,))],
        "sku_name string, price_start_time timestamp_ntz, price_end_time timestamp_ntz, pricing struct<default: double>",
    )
    cost = usage.usage_cost(use, prices, date(2024, 1, 31))
    assert rows(cost) == [("p", "s", 5.0, 32.0)]
    assert "NestedLoop" not in executed_plan(cost)


def test_headers_without_lines(spark):
    headers = spark.createDataFrame([("1000", "d1", 2024), ("1000", "d2", 2024)], "BUKRS string, BELNR string, GJAHR int")
    lines = spark.createDataFrame([("1000", "d1", 2024, "001", 10.0)], "BUKRS string, BELNR string, GJAHR int, BUZEI string, DMBTR double")
    assert rows(joins.new_keys(headers, lines, finance.DOCUMENT_KEYS)) == [("1000", "d2", 2024)]
    summary = finance.doc_line_summary(headers.withColumn("WAERK", F.lit("COP")), lines).first()
    assert (summary.num_documents, summary.num_lines, summary.avg_amount) == (1, 1, 10.0)


def test_parameters_are_bound(spark, folder):
    report = finance.doc_type_report(spark, erp.bkpf(spark, folder), erp.bseg(spark, folder), "1000' OR '1'='1", 2023, "COP")
    assert report.count() == 0


def test_broadcast_only_within_the_limit(spark, folder):
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    orders = erp.order_headers(spark, folder)
    small = orders.join(joins.broadcast_if_small(customers), F.col("KUNNR").try_cast("long") == F.col("c_custkey"))
    assert "BroadcastHashJoin" in executed_plan(small)
    size = joins.estimated_bytes(customers)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = orders.join(joins.broadcast_if_small(customers, size - 1), F.col("KUNNR").try_cast("long") == F.col("c_custkey"))
        assert "SortMergeJoin" in executed_plan(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_date_filter_and_columns_reach_the_scan(spark, folder):
    plan = executed_plan(gold.top_customers_in_year(gold.orders_gold(erp.order_headers(spark, folder)), 1998))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in plan
    pruned = executed_plan(gold.sales_by_org_currency(erp.order_headers(spark, folder)))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in pruned


def test_documents_are_shuffled_once_for_their_lines(spark, folder):
    headers = silver.accounting_silver(erp.bkpf(spark, folder))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed_plan(finance.fin_summary(headers, erp.bseg(spark, folder)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(BUKRS") == 4


def test_compaction_and_clustering_keep_rows(spark, tmp_path):
    df = spark.range(300).select("id", (F.col("id") % 3).alias("g"))
    df.repartition(60).write.parquet(str(tmp_path / "small"))
    health = layout.file_health(spark, {"small": str(tmp_path / "small")}).first()
    assert health.num_files == 60 and health.small_files
    layout.compact_files(spark, str(tmp_path / "small"), str(tmp_path / "big"))
    assert rows(spark.read.parquet(str(tmp_path / "big"))) == rows(df)
    assert layout.table_files(spark, str(tmp_path / "big")).count() == 1
    for _ in range(4):
        df.write.mode("append").partitionBy("g").parquet(str(tmp_path / "parts"))
    layout.compact_files(spark, str(tmp_path / "parts"), str(tmp_path / "whole"), ["g"])
    assert layout.table_files(spark, str(tmp_path / "whole")).count() == 3
    assert spark.read.parquet(str(tmp_path / "whole")).count() == 1200
    layout.cluster_layout(df, str(tmp_path / "clustered"), ["g"], files=4)
    assert rows(spark.read.parquet(str(tmp_path / "clustered"))) == rows(df)
    with pytest.raises(ValueError):
        layout.cluster_layout(df, str(tmp_path / "none"), [])


def test_a_hot_value_is_spread_over_cluster_files(spark, tmp_path):
    df = spark.range(30_000).select("id", F.when(F.col("id") < 20_000, 1).otherwise(F.col("id")).alias("g"))
    layout.cluster_layout(df, str(tmp_path / "c"), ["g"], files=6)
    with_hot = spark.read.parquet(str(tmp_path / "c")).where("g = 1").select(F.col("_metadata.file_path")).distinct()
    assert with_hot.count() >= 4


def test_published_columns_are_an_allow_list(spark, tmp_path):
    df = spark.createDataFrame([("1", "Customer", "CO", "secret")], "KUNNR string, NAME1 string, LAND1 string, STRAS string")
    shown = publish.masked(df, ["NAME1"], ["KUNNR", "LAND1"])
    assert shown.columns == ["KUNNR", "NAME1_masked", "LAND1"]
    publish.publish_dataset({"customers.masked": shown}, str(tmp_path))
    assert rows(publish.consume_published(spark, str(tmp_path), "customers.masked")) == [("1", "Cus***", "CO")]
    with pytest.raises(ValueError):
        publish.alias_path("x", "nodomain")


def test_left_join_to_facts_keeps_all_masters(spark):
    master = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, n string")
    facts = spark.createDataFrame([(1, 10), (1, 11), (3, 12), (9, 13)], "k int, v int")
    assert rows(joins.join_facts(master, facts, ["k"])) == rows(master.join(facts, "k", "left"))


def test_partitioned_compaction_keeps_to_the_target_size(spark, tmp_path):
    rows = spark.range(60_000).select((F.col("id") % 10 == 0).cast("int").alias("g"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    rows.repartition(20).write.partitionBy("g").parquet(str(tmp_path / "small"))
    layout.compact_files(spark, str(tmp_path / "small"), str(tmp_path / "mb"), ["g"], target_mb=1)
    layout.compact_files(spark, str(tmp_path / "small"), str(tmp_path / "all"), ["g"], target_mb=4096)
    fine, coarse = (layout.table_files(spark, str(tmp_path / n)).count() for n in ("mb", "all"))
    assert coarse == 2 and fine > 3
    assert spark.read.parquet(str(tmp_path / "mb")).distinct().count() == 60_000


def test_few_periods_go_to_the_facts(spark):
    from lakekit.operators.joins import join_validity

    facts = spark.range(1000).select(F.concat(F.lit("sku"), F.floor(F.col("id") / 5000)).alias("k"), F.col("id").alias("at"))
    periods = spark.createDataFrame([("sku0", 0, 500), ("sku0", 500, None)], "k string, a long, b long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = join_validity(facts, periods, "k", "at", "a", "b")
        assert joined.count() == 1000
        assert "BroadcastHashJoin" in executed_plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
