"""Registered queries: upserts, versions and change feeds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lakekit.functions.money import total
from lakekit.operators import changes, history
from lakekit.operators.cleaning import add_constants, value_counts
from lakekit.plans import gold
from lakekit.registry import inputs
from lakekit.registry.sql import money_sum, month, rdiv, step_feed, sum_cents, year
from lakekit.sources import erp
from lakekit.sources.files import append_evolving, read_evolved
from lakekit.sources.workspace import fresh_dir
from lakekit.streaming.chains import sales_of_batch

KEY = ["c_custkey"]
KPI_KEYS = ["year", "month", "sales_org", "currency"]
SPLIT = datetime(1999, 6, 15)


def _feed(spark, d):
    first, second, third = inputs.customer_states(spark, d)
    step = changes.change_feed(first, second, KEY, 1, inputs.COMMIT_TIMES[1])
    return step.unionByName(changes.change_feed(second, third, KEY, 2, inputs.COMMIT_TIMES[2]))


def _sales_before(spark, d):
    """Monthly sales of the older orders, with their mean."""
    older = erp.order_headers(spark, d).where(F.col("ERDAT") < F.lit(SPLIT.date()))
    return gold.sales_kpis_monthly(older)


def _sales_batch(spark, d):
    return sales_of_batch(erp.order_headers(spark, d).where(F.col("ERDAT") >= F.lit(SPLIT.date())))


def _accumulated(spark, d):
    return changes.merge_accumulate(
        _sales_before(spark, d), _sales_batch(spark, d), KPI_KEYS, "num_orders", "total_revenue", "avg_order_value"
    )


def _at_moment(spark, d):
    return history.snapshot_as_of(spark, inputs.customer_history(spark, d), at=datetime(2024, 2, 15))


def _compared(spark, d):
    return history.snapshot_compare(
        spark,
        inputs.customer_history(spark, d),
        (0, 1),
        F.count(F.lit(1)).alias("num_rows"),
        F.count_distinct("c_mktsegment").alias("segments"),
        total("c_acctbal").alias("balance"),
    )


def _restored(spark, d):
    path = inputs.customer_history(spark, d)
    version = history.snapshot_restore(spark, path, 0, datetime(2024, 4, 1))
    return history.snapshot_as_of(spark, path, version)


def _history_log(spark, d):
    path = inputs.customer_history(spark, d)
    history.snapshot_restore(spark, path, 1, datetime(2024, 4, 1))
    return history.snapshot_history(spark, path)


def _tier_changes(spark, d):
    """Customer tiers after a bulk promotion, as the rows a receiver has to fetch."""
    limit = F.col("total_revenue") > 2_500_000
    before = inputs.customer_360(spark, d).select(
        "customer_id", "total_revenue", F.when(limit, "GOLD").otherwise("STANDARD").alias("customer_tier")
    )
    after = changes.update_where(before, F.col("customer_tier") == "GOLD", {"customer_tier": F.lit("PLATINUM")})
    return changes.changes_to_ship(
        changes.change_feed(before, after, ["customer_id"], 1, inputs.COMMIT_TIMES[1])
    )


def _evolved(spark, d):
    """Two loads of the accounting headers, the second one with three new columns, read as one table."""
    path = fresh_dir(spark, "evolving")
    headers = erp.bkpf(spark, d)
    append_evolving(headers, path)
    append_evolving(add_constants(headers, {"KOSTL": "CC001", "SEGMENT": "SEG01", "MANDT": "100"}), path)
    return read_evolved(spark, path)


QUERIES = {
    "merge_upsert": lambda s, d: changes.merge_upsert(
        inputs.customer_states(s, d)[0],
        inputs.customer_states(s, d)[2].where(F.col("c_mktsegment").isin("XXX", "SUPPLIER")),
        KEY,
    ),
    "merge_accumulate": _accumulated,
    "merge_changes": lambda s, d: changes.merge_changes(inputs.customer_states(s, d)[0], _feed(s, d), KEY),
    "insert_new_only": lambda s, d: changes.insert_new_only(
        inputs.customer_states(s, d)[0], inputs.customer_states(s, d)[2], KEY
    ),
    "update_where": lambda s, d: changes.update_where(
        inputs.customer_states(s, d)[0],
        F.col("c_mktsegment") == "BUILDING",
        {"c_mktsegment": F.lit("DATO_INCORRECTO"), "c_acctbal": F.col("c_acctbal") * 2},
    ),
    "snapshot_as_of": _at_moment,
    "snapshot_compare": _compared,
    "snapshot_restore": _restored,
    "snapshot_history": _history_log,
    "change_feed": lambda s, d: changes.change_feed(
        inputs.customer_states(s, d)[0], inputs.customer_states(s, d)[2], KEY, 2, inputs.COMMIT_TIMES[2]
    ),
    "change_feed_range": lambda s, d: history.change_feed_range(s, inputs.customer_history(s, d), KEY, 1, 2),
    "change_counts": lambda s, d: changes.change_counts(_feed(s, d)),
    "change_savings": lambda s, d: changes.change_savings(inputs.customer_states(s, d)[2], _feed(s, d)),
    "filter_change_types": lambda s, d: changes.changes_to_ship(_feed(s, d)),
    "replica_refresh": lambda s, d: changes.merge_changes(
        inputs.customer_states(s, d)[0], _feed(s, d), KEY, deletes=True
    ),
    "append_evolve_schema": lambda s, d: value_counts(
        _evolved(s, d), "KOSTL", "SEGMENT", "MANDT"
    ),
    "promote_tier": _tier_changes,
}


ORACLES = {
    "merge_upsert": """SELECT * FROM hist0 WHERE c_custkey NOT IN
            (SELECT c_custkey FROM hist2 WHERE c_mktsegment IN ('XXX', 'SUPPLIER'))
        UNION ALL SELECT * FROM hist2 WHERE c_mktsegment IN ('XXX', 'SUPPLIER')""",
    "merge_accumulate": f"""WITH old AS (SELECT {year('ERDAT')} AS year, {month('ERDAT')} AS month,
            VKORG AS sales_org, WAERK AS currency, count(DISTINCT KUNNR) AS num_customers,
            max(NETWR) AS max_order_value, min(NETWR) AS min_order_value, count(*) AS n, {sum_cents('NETWR')} AS c,
            {rdiv(sum_cents('NETWR'), '(100 * count(*))', 2)} AS m
            FROM vbak WHERE ERDAT < DATE '1999-06-15' AND NETWR > 0 GROUP BY 1, 2, 3, 4),
        new AS (SELECT {year('ERDAT')} AS year, {month('ERDAT')} AS month, VKORG AS sales_org, WAERK AS currency,
            count(*) AS nn, {sum_cents('NETWR')} AS nc FROM vbak WHERE ERDAT >= DATE '1999-06-15' GROUP BY 1, 2, 3, 4)
        SELECT year, month, sales_org, currency, coalesce(n, 0) + coalesce(nn, 0) AS num_orders, num_customers,
            CAST(coalesce(c + nc, c, nc) AS DOUBLE) / 100 AS total_revenue,
            CASE WHEN nn IS NULL THEN m ELSE CAST(coalesce(c + nc, c, nc) AS DOUBLE) / 100
                / (coalesce(n, 0) + coalesce(nn, 0)) END AS avg_order_value,
            max_order_value, min_order_value
        FROM (SELECT coalesce(o.year, w.year) AS year, coalesce(o.month, w.month) AS month,
            coalesce(o.sales_org, w.sales_org) AS sales_org, coalesce(o.currency, w.currency) AS currency,
            num_customers, max_order_value, min_order_value, n, c, m, nn, nc
            FROM old o FULL JOIN new w ON o.year = w.year AND o.month = w.month
            AND o.sales_org IS NOT DISTINCT FROM w.sales_org AND o.currency = w.currency)""",
    "merge_changes": """SELECT * FROM hist2 UNION ALL SELECT * FROM hist1 WHERE NOT coalesce(c_acctbal >= 0, FALSE)""",
    "insert_new_only": "SELECT * FROM hist2 WHERE c_custkey NOT IN (SELECT c_custkey FROM hist0)",
    "update_where": """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'DATO_INCORRECTO'
        ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal * 2
        ELSE c_acctbal END AS c_acctbal FROM hist0""",
    "snapshot_as_of": "SELECT * FROM hist1",
    "snapshot_compare": f"""SELECT 0 AS version, count(*) AS num_rows, count(DISTINCT c_mktsegment) AS segments,
            {money_sum('c_acctbal')} AS balance FROM hist0
        UNION ALL SELECT 1, count(*), count(DISTINCT c_mktsegment), {money_sum('c_acctbal')} FROM hist1""",
    "snapshot_restore": "SELECT * FROM hist0",
    "snapshot_history": """SELECT 0 AS version, TIMESTAMP '2024-01-01' AS committed_at, 'CREATE' AS operation,
            count(*) AS num_rows FROM hist0
        UNION ALL SELECT 1, TIMESTAMP '2024-02-01', 'UPDATE', count(*) FROM hist1
        UNION ALL SELECT 2, TIMESTAMP '2024-03-01', 'MERGE', count(*) FROM hist2
        UNION ALL SELECT 3, TIMESTAMP '2024-04-01', 'RESTORE 1', count(*) FROM hist1""",
    "change_feed": step_feed("hist0", "hist2", 2, "2024-03-01 00:00:00"),
    "change_feed_range": "SELECT * FROM feed",
    "change_counts": "SELECT _change_type, count(*) AS num_rows FROM feed GROUP BY _change_type",
    "change_savings": """SELECT t AS total_rows, f AS shipped_rows, t - f AS saved_rows
        FROM (SELECT (SELECT count(*) FROM hist2) AS t,
              (SELECT count(*) FROM feed WHERE _change_type IN ('insert', 'update_postimage')) AS f)""",
    "filter_change_types": "SELECT * FROM feed WHERE _change_type IN ('insert', 'update_postimage')",
    "replica_refresh": "SELECT * FROM hist2",
    "append_evolve_schema": """SELECT KOSTL, SEGMENT, MANDT, n AS num_rows, 50.0::DOUBLE AS percent_of_total
        FROM (SELECT NULL AS KOSTL, NULL AS SEGMENT, NULL AS MANDT, count(*) AS n FROM bkpf
              UNION ALL SELECT 'CC001', 'SEG01', '100', count(*) FROM bkpf)""",
    "promote_tier": """SELECT customer_id, total_revenue, 'PLATINUM' AS customer_tier,
        'update_postimage' AS _change_type, CAST(1 AS BIGINT) AS _commit_version,
        TIMESTAMP '2024-02-01' AS _commit_timestamp FROM c360 WHERE total_revenue > 2500000""",
}
