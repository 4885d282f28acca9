"""Registered queries: file layout and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.operators import changes, layout, publish
from lakekit.registry import inputs
from lakekit.sources import erp
from lakekit.sources.workspace import fresh_dir


def _many_files(spark, d) -> str:
    """Orders appended channel by channel to monthly folders: several small files in each."""
    path = fresh_dir(spark, "many-files")
    monthly = erp.order_headers(spark, d).withColumn("period", F.date_format("ERDAT", "yyyy-MM"))
    for channel in ("F", "O", "P"):
        monthly.where(F.col("VTWEG") == channel).hint("rebalance", F.col("period")).write.mode("append").partitionBy(
            "period"
        ).parquet(path)
    return path


def _file_health(spark, d):
    whole = fresh_dir(spark, "one-table")
    erp.order_headers(spark, d).write.parquet(whole)
    return layout.file_health(spark, {"orders_by_month": _many_files(spark, d), "orders": whole})


def _compacted(spark, d):
    old, new = _many_files(spark, d), fresh_dir(spark, "compacted")
    layout.compact_files(spark, old, new, ["period"])
    before, after = (layout.table_files(spark, p).agg(F.count(F.lit(1))).scalar() for p in (old, new))
    tables = {"before": spark.read.parquet(old), "after": layout.read_compacted(spark, old, new)}
    rows = [t.agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(stage).alias("stage"), "num_rows") for stage, t in tables.items()]
    return rows[0].unionByName(rows[1]).withColumn("fewer_files", after < before)


def _clustered(spark, d):
    path = layout.cluster_layout(erp.order_headers(spark, d), fresh_dir(spark, "clustered"), ["KUNNR", "VKORG"])
    return spark.read.parquet(path)


CLUSTERED = ("l_orderkey", "l_partkey", "l_extendedprice")


def _skipping(spark, d):
    """Rows with a middle value of each filter column in lines clustered by all three, and whether few files hold them."""
    lines = erp.read_table(spark, d, "lineitem")
    path = layout.cluster_layout(lines, fresh_dir(spark, "clustered-lines"), CLUSTERED, files=64)
    clustered = spark.read.parquet(path)
    middle = {c: lines.agg(((F.min(c) + F.max(c)) / 2).alias(c)).scalar() for c in CLUSTERED}
    probes = {c: lines.where(F.col(c) <= m).agg(F.max(c)).scalar() for c, m in middle.items()}
    counts = [
        clustered.where(F.col(c) == v).agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(c).alias("column"), "num_rows")
        for c, v in probes.items()
    ]
    counted = counts[0].unionByName(counts[1]).unionByName(counts[2])
    few = (3 * F.col("files_read") <= F.col("num_files")).alias("few_files")
    return layout.files_to_read(spark, path, probes).join(counted, "column").select("column", "num_rows", few)


def _published(spark, d):
    share = fresh_dir(spark, "share")
    tables = {
        "sales.monthly_kpis": inputs.monthly_kpis(spark, d),
        "customers.customer_360": inputs.customer_360(spark, d),
        "sales.orders": inputs.gold_orders(spark, d),
    }
    publish.publish_dataset(tables, share)
    listing = [
        publish.consume_published(spark, share, alias)
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .select(F.lit(alias).alias("alias"), "num_rows")
        for alias in tables
    ]
    return listing[0].unionByName(listing[1]).unionByName(listing[2])


def _publish_and_read(spark, df, alias):
    share = fresh_dir(spark, "share")
    publish.publish_dataset({alias: df}, share)
    return publish.consume_published(spark, share, alias)


def _with_history(spark, d):
    share, path = fresh_dir(spark, "share"), inputs.customer_history(spark, d)
    states = inputs.customer_states(spark, d)
    feed = changes.change_feed(states[0], states[1], ["c_custkey"], 1, inputs.COMMIT_TIMES[1])
    publish.publish_with_history(spark, path, feed, share, "customers.master")
    target = publish.alias_path(share, "customers.master")
    states_read = spark.read.parquet(f"{target}/states").groupBy(F.col("_version").cast("int").alias("version"))
    changes_read = spark.read.parquet(f"{target}/changes").groupBy(F.col("_commit_version").cast("int").alias("version"))
    return (
        states_read.agg(F.count(F.lit(1)).alias("num_rows"))
        .withColumn("part", F.lit("states"))
        .unionByName(changes_read.agg(F.count(F.lit(1)).alias("num_rows")).withColumn("part", F.lit("changes")))
    )


def _consumed(spark, d):
    """A published table joined with a local one."""
    shared = _publish_and_read(spark, inputs.customer_360(spark, d), "customers.customer_360")
    local = inputs.gold_orders(spark, d).groupBy("codigo_cliente").agg(
        F.count_if("es_devolucion").alias("returns")
    )
    return shared.join(local, F.col("customer_id") == F.col("codigo_cliente"), "left").select(
        "customer_id", "customer_name", "total_revenue", "returns"
    )


QUERIES = {
    "file_health": _file_health,
    "compact_files": _compacted,
    "cluster_layout": _clustered,
    "cluster_layout_skipping": _skipping,
    "publish_dataset": _published,
    "publish_row_subset": lambda s, d: _publish_and_read(
        s, publish.row_subset(erp.kna1(s, d), "LAND1", "NATION_7"), "customers.one_country"
    ),
    "publish_masked": lambda s, d: _publish_and_read(
        s, publish.masked(erp.kna1(s, d), ["NAME1"], ["KUNNR", "LAND1", "ORT01"]), "customers.customers_masked"
    ),
    "publish_with_history": _with_history,
    "consume_published": _consumed,
}

ORACLES = {
    "compact_files": """SELECT 'before' AS stage, count(*) AS num_rows, TRUE AS fewer_files FROM vbak
        UNION ALL SELECT 'after', count(*), TRUE FROM vbak""",
    "cluster_layout": "SELECT * FROM vbak",
    "cluster_layout_skipping": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS num_rows, TRUE AS few_files FROM lineitem WHERE {c} =
        (SELECT max({c}) FROM lineitem WHERE {c} <= (SELECT (min({c}) + max({c})) / 2 FROM lineitem))"""
        for c in CLUSTERED
    ),
    "publish_dataset": """SELECT 'sales.monthly_kpis' AS alias, count(*) AS num_rows FROM kpis
        UNION ALL SELECT 'customers.customer_360', count(*) FROM c360
        UNION ALL SELECT 'sales.orders', count(*) FROM vgold""",
    "publish_row_subset": "SELECT * FROM kna1 WHERE LAND1 = 'NATION_7'",
    "publish_masked": "SELECT KUNNR, substr(NAME1, 1, 3) || '***' AS NAME1_masked, LAND1, ORT01 FROM kna1",
    "publish_with_history": """SELECT 0 AS version, count(*) AS num_rows, 'states' AS part FROM hist0
        UNION ALL SELECT 1, count(*), 'states' FROM hist1 UNION ALL SELECT 2, count(*), 'states' FROM hist2
        UNION ALL SELECT 1, 2 * count(*), 'changes' FROM hist0 WHERE c_mktsegment = 'BUILDING'""",
    "consume_published": """SELECT customer_id, customer_name, total_revenue, returns FROM c360 LEFT JOIN
        (SELECT codigo_cliente, count(*) FILTER (WHERE es_devolucion) AS returns FROM vgold GROUP BY codigo_cliente)
        ON customer_id = codigo_cliente""",
}
