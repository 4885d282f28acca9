"""Registered queries: expectations, quarantine, gates and chained loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.operators import quality
from lakekit.registry.sql import money_mean, money_sum, month, year
from lakekit.sources import erp
from lakekit.sources.files import stage_csv
from lakekit.sources.workspace import fresh_dir
from lakekit.streaming.chains import OrderLoad, stream_bronze_silver_gold

def _rules():
    return {
        "value_large": F.col("value") > 5,
        "value_plausible": F.col("value") < 250,
        "no_error": F.col("event_type") != "error",
    }


def _events(spark, d):
    return erp.read_table(spark, d, "events").select("event_id", "event_type", "value")


def _quarantine(spark, d):
    valid, rejected = quality.quarantine_split(_events(spark, d), _rules())
    return valid.withColumn("failed", F.lit("")).unionByName(
        rejected.withColumn("failed", F.array_join("failed_rules", ",")).drop("failed_rules")
    )


def _facts(bronze):
    """Events as facts; errors have no zone."""
    return bronze.select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("zone"),
        F.col("value").alias("amount"),
        F.length("event_type").cast("double").alias("distance"),
        F.col("ts").alias("happened_at"),
        "_ingested_at",
    )


def _streamed_zones(spark, d):
    schema = erp.read_table(spark, d, "events").schema
    return stream_bronze_silver_gold(
        spark, d, schema, _facts, "events", fresh_dir(spark, "zones"), name_pattern="events.parquet"
    )


def _chained(spark, d):
    """Orders landing in two overlapping batches; the overlap is counted once."""
    work = fresh_dir(spark, "order-load")
    load = OrderLoad(f"{work}/landing", work)
    orders = erp.vbak(spark, d)
    stage_csv(orders.where(F.col("AUART") != "1-URGENT"), f"{load.landing}/batch_01")
    load.run(spark)
    stage_csv(orders.where(F.col("AUART").isin("1-URGENT", "2-HIGH")), f"{load.landing}/batch_02")
    load.run(spark)
    load.run(spark)
    return load.current_sales(spark)


def _pipelined(spark, d):
    """Orders landing in four batches, each overlapping the one before; sales folded together after every second."""
    work = fresh_dir(spark, "order-pipeline")
    load = OrderLoad(f"{work}/landing", work, fan=2)
    orders = erp.vbak(spark, d)
    types = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    for i in range(4):
        stage_csv(orders.where(F.col("AUART").isin(*types[i : i + 2])), f"{load.landing}/batch_{i:02d}")
        load.run(spark)
    return load.current_sales(spark)


QUERIES = {
    "expect_warn": lambda s, d: quality.expect_warn(_events(s, d), _rules()).withColumn(
        "warnings", F.array_join("warnings", ",")
    ),
    "expect_drop": lambda s, d: quality.expect_drop(_events(s, d), _rules()),
    "expect_fail": lambda s, d: quality.expect_fail(_events(s, d), {"not_negative": F.col("value") >= 0}),
    "expectation_metrics": lambda s, d: quality.expectation_metrics(_events(s, d), _rules()),
    "quarantine_split": _quarantine,
    "quality_gate": lambda s, d: quality.gate_report(_events(s, d), _rules(), (100, 1_000_000_000)),
    "stream_bronze_silver_gold": _streamed_zones,
    "incremental_load_chain": _chained,
    "incremental_pipeline": _pipelined,
}

FAILED = """concat_ws(',', CASE WHEN (value > 5) IS NOT TRUE THEN 'value_large' END,
    CASE WHEN (value < 250) IS NOT TRUE THEN 'value_plausible' END, CASE WHEN event_type = 'error' THEN 'no_error' END)"""

SALES = f"""SELECT {year('ERDAT')} AS year, {month('ERDAT')} AS month, VKORG AS sales_org,
        WAERK AS currency, count(*) AS num_orders, {money_sum('NETWR')} AS total_revenue,
        {money_sum('NETWR')} / count(*) AS avg_order_value
        FROM vbak WHERE AUART IS NOT NULL GROUP BY 1, 2, 3, 4"""

ORACLES = {
    "expect_warn": f"SELECT event_id, event_type, value, {FAILED} AS warnings FROM events",
    "expect_drop": """SELECT event_id, event_type, value FROM events
        WHERE value > 5 AND value < 250 AND event_type <> 'error'""",
    "expect_fail": "SELECT event_id, event_type, value FROM events WHERE value >= 0",
    "expectation_metrics": """SELECT 'value_large' AS rule, count(*) FILTER (WHERE value > 5) AS passed,
            count(*) FILTER (WHERE (value > 5) IS NOT TRUE) AS failed FROM events
        UNION ALL SELECT 'value_plausible', count(*) FILTER (WHERE value < 250),
            count(*) FILTER (WHERE (value < 250) IS NOT TRUE) FROM events
        UNION ALL SELECT 'no_error', count(*) FILTER (WHERE event_type <> 'error'),
            count(*) FILTER (WHERE event_type = 'error') FROM events""",
    "quarantine_split": f"SELECT event_id, event_type, value, {FAILED} AS failed FROM events",
    "quality_gate": f"""SELECT n AS rejected_rows, row_limit, n <= row_limit AS passes
        FROM (SELECT count(*) FILTER (WHERE {FAILED} <> '') AS n FROM events)
        CROSS JOIN (SELECT unnest([100, 1000000000]) AS row_limit)""",
    "stream_bronze_silver_gold": f"""SELECT user_id AS zone, {year('ts')} AS year, {month('ts')} AS month,
        count(*) AS num_facts, {money_sum('value')} AS revenue_total, {money_mean('value')} AS ticket_promedio,
        {money_mean('length(event_type)')} AS distancia_promedio
        FROM events WHERE event_type <> 'error' AND user_id IS NOT NULL GROUP BY 1, 2, 3""",
    "incremental_load_chain": SALES,
    "incremental_pipeline": SALES,
}
