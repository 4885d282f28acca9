"""Registered queries: sources, sinks and ingestion. What is read back is compared with what was given."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.cleaning import add_constants
from lakekit.plans import gold, silver
from lakekit.registry import inputs
from lakekit.registry.sql import VIEWS
from lakekit.schemas import ERP_SCHEMAS
from lakekit.sources import erp, files
from lakekit.sources.workspace import fresh_dir
from lakekit.streaming.ingest import incremental_files, read_batches, rescue_monitor, stream_table_read
from lakekit.values import BRONZE_PARTITIONS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
COMMENTS = {
    "VBELN": "Order number, ten digits",
    "ERDAT": "Creation date",
    "KUNNR": "Customer",
    "NETWR": "Net value in order currency",
    "AUART": "Order type",
}


def _csv_read_typed(spark, d):
    staged = files.stage_csv(erp.vbak(spark, d), fresh_dir(spark, "orders-csv"))
    return files.read_csv(spark, staged, ERP_SCHEMAS["VBAK"])


def _csv_stage_write(spark, d):
    staged = files.stage_csv(erp.kna1(spark, d), fresh_dir(spark, "customers-csv"))
    return spark.read.option("header", True).csv(staged)


def _source_inventory(spark, d):
    return files.source_inventory(
        spark, {name: partial(erp.read_table, spark, d, name) for name in [*TABLES, "ledger"]}
    )


def _layers(spark, d):
    orders = silver.orders_silver(erp.vbak(spark, d))
    return files.layer_inventory(
        spark,
        {
            "vbak_bronze": erp.vbak(spark, d),
            "vbap_bronze": erp.vbap(spark, d),
            "vbak_silver": orders,
            "kna1_silver": inputs.silver_customers(spark, d),
            "gold_sales_kpis": gold.sales_kpis_monthly(orders),
            "vbak_gold": inputs.gold_orders(spark, d),
            "nation": erp.read_table(spark, d, "nation"),
        },
    )


def _bronze_all(spark, d):
    tables = {name: read(spark, d) for name, read in erp.ERP_TABLES.items()}
    paths = files.bronze_ingest_all(tables, BRONZE_PARTITIONS, fresh_dir(spark, "bronze"), inputs.CLOCK)
    parts = []
    for name, path in paths.items():
        stored, by = spark.read.parquet(path), BRONZE_PARTITIONS[name]
        measures = [F.count(F.lit(1)).alias("num_rows")]
        measures.append((F.count_distinct(by) if by else F.lit(0).cast("bigint")).alias("num_partitions"))
        parts.append(stored.agg(*measures).select(F.lit(name).alias("table_name"), "num_rows", "num_partitions"))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _create_if_missing(spark, d):
    path = fresh_dir(spark, "once")
    states = []
    for attempt, table in enumerate(("VBAK", "VBAP")):
        state = files.create_if_missing(spark, path, lambda: erp.ERP_TABLES[table](spark, d))
        stored = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("num_rows"))
        states.append(stored.select(F.lit(attempt).alias("attempt"), F.lit(state).alias("state"), "num_rows"))
    return states[0].unionByName(states[1])


def _partitioned(spark, d) -> DataFrame:
    return spark.read.parquet(files.write_partitioned(erp.bkpf(spark, d), fresh_dir(spark, "headers"), "GJAHR"))


def _documented(spark, d):
    columns = list(COMMENTS)
    path = files.write_documented(erp.order_headers(spark, d).select(*columns), fresh_dir(spark, "documented"), COMMENTS)
    stored = spark.read.parquet(path)
    comments = files.column_comments(stored)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(comments[c]).alias("comment"), F.col(c).alias("filled"))
            for c in columns
        ]
    )
    return stored.agg(*[F.count(c).alias(c) for c in columns]).select(F.inline(rows))


def _append_strict(spark, d):
    path = fresh_dir(spark, "strict")
    headers = erp.bkpf(spark, d)
    headers.write.parquet(path)
    files.append_strict(spark, headers, path)
    try:
        files.append_strict(spark, add_constants(headers, {"KOSTL": "CC001"}), path)
        outcome = "accepted"
    except files.SchemaDrift:
        outcome = "rejected"
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("num_rows")).withColumn("drifted", F.lit(outcome))


def _land_batch(spark, d):
    landed = files.land_batch(erp.vbak(spark, d), fresh_dir(spark, "landing"), "newest", 50, newest_by="VBELN")
    return files.read_csv(spark, landed, ERP_SCHEMAS["VBAK"])


def _incremental(spark, d):
    """Three runs over a landing folder: one batch, nothing new, one more batch. Files of other names are skipped."""
    work = fresh_dir(spark, "incremental")
    landing, target = f"{work}/landing", f"{work}/bronze"
    orders = erp.vbak(spark, d)

    def run(number: int) -> DataFrame:
        incremental_files(spark, landing, ERP_SCHEMAS["VBAK"], f"{work}/checkpoint", target)
        # The count is taken now: a later run adds files to the same folder.
        total = read_batches(spark, target).count()
        return spark.range(1).select(F.lit(number).alias("run"), F.lit(total).cast("bigint").alias("total_rows"))

    files.stage_csv(orders.where(F.col("AUART") != "1-URGENT"), f"{landing}/batch_01")
    orders.select("VBELN").write.text(f"{landing}/notes")
    report = run(1).unionByName(run(2))
    files.stage_csv(orders.where(F.col("AUART") == "1-URGENT"), f"{landing}/batch_02")
    return report.unionByName(run(3))


def _drifted(spark, d) -> DataFrame:
    """Rescued rows of two CSV layouts: the declared one, and one with a new column and amounts that are no numbers."""
    work = fresh_dir(spark, "drift")
    landing, target = f"{work}/landing", f"{work}/bronze"
    orders = erp.vbak(spark, d)
    files.stage_csv(orders.where(F.col("VTWEG") != "F"), f"{landing}/usual")
    amount = F.when(F.col("AUART") == "1-URGENT", F.lit("n/a")).otherwise(F.col("NETWR").cast("string"))
    changed = orders.where(F.col("VTWEG") == "F").select(
        "VBELN", "ERDAT", "AUART", "KUNNR", amount.alias("NETWR"), "WAERK", F.col("SPART").alias("ZZREGION_NUEVA")
    )
    files.stage_csv(changed, f"{landing}/changed")
    incremental_files(spark, landing, ERP_SCHEMAS["VBAK"], f"{work}/checkpoint", target)
    return read_batches(spark, target).drop("_batch", "_ingested_at")


def _streamed(spark, d):
    work = fresh_dir(spark, "stream-table")
    schema = erp.read_table(spark, d, "orders").schema
    stream_table_read(spark, d, schema, "orders", f"{work}/bronze", f"{work}/checkpoint", "orders.parquet")
    return spark.read.parquet(f"{work}/bronze").drop("_ingested_at")


QUERIES = {
    "csv_read_typed": _csv_read_typed,
    "csv_stage_write": _csv_stage_write,
    "source_inventory": _source_inventory,
    "layer_inventory": _layers,
    "bronze_ingest": lambda s, d: files.bronze_ingest(
        erp.vbap(s, d), "VBAP.csv", inputs.CLOCK, source_system="ERP", batch_id="20240601_080000"
    ),
    "bronze_ingest_all": _bronze_all,
    "create_if_missing": _create_if_missing,
    "write_partitioned": lambda s, d: _partitioned(s, d).groupBy("GJAHR").agg(F.count(F.lit(1)).alias("num_rows")),
    "filter_partition": lambda s, d: _partitioned(s, d).where("GJAHR = 2024"),
    "ctas_documented": _documented,
    "append_strict": _append_strict,
    "land_batch": _land_batch,
    "incremental_files": _incremental,
    "file_lineage_columns": lambda s, d: files.with_file_lineage(erp.read_table(s, d, "lineitem"))
    .groupBy(F.regexp_extract("_source_file", r"([a-z]+)\.parquet", 1).alias("source_table"))
    .agg(F.count(F.lit(1)).alias("num_rows"), F.count_distinct("l_orderkey").alias("orders")),
    "rescue_unknown": lambda s, d: _drifted(s, d).drop("_source_file", "_source_file_name"),
    "rescue_monitor": lambda s, d: rescue_monitor(_drifted(s, d)),
    "stream_table_read": _streamed,
    "binary_files": lambda s, d: files.binary_files(s, d, "*.parquet").select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "length"
    ),
}

COUNTS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
    "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4,
}
TEXT_ORDERS = VIEWS["vbak"].replace("CAST(o_orderdate AS DATE) AS ERDAT", "strftime(o_orderdate, '%Y%m%d') AS ERDAT")
LAYERS = (
    ("BRONZE", "vbak_bronze", "orders"),
    ("BRONZE", "vbap_bronze", "lineitem"),
    ("SILVER", "vbak_silver", "orders"),
    ("SILVER", "kna1_silver", "customer"),
    ("GOLD", "gold_sales_kpis", "kpis"),
    ("GOLD", "vbak_gold", "orders"),
    ("OTHER", "nation", "nation"),
)

ORACLES = {
    "csv_read_typed": TEXT_ORDERS,
    "csv_stage_write": "SELECT * FROM kna1",
    "source_inventory": " UNION ALL ".join(
        f"SELECT '{t}' AS source, count(*) AS num_rows, {n} AS num_columns, 'ok' AS status FROM {t}"
        for t, n in COUNTS.items()
    )
    + " UNION ALL SELECT 'ledger', NULL, NULL, 'missing'",
    "layer_inventory": "WITH t AS ("
    + " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS n FROM {source}"
        for layer, name, source in LAYERS
    )
    + """) SELECT coalesce(layer, 'ALL') AS layer, coalesce(table_name, 'ALL') AS table_name,
        CAST(sum(n) AS BIGINT) AS num_rows, count(*) AS num_tables FROM t GROUP BY ROLLUP (layer, table_name)""",
    "bronze_ingest": """SELECT *, TIMESTAMP '2024-06-01 08:00:00' AS _loaded_at, 'VBAP.csv' AS _source_file,
        'ERP' AS _source_system, '20240601_080000' AS _batch_id FROM vbap""",
    "bronze_ingest_all": """SELECT 'BKPF' AS table_name, count(*) AS num_rows, count(DISTINCT GJAHR) AS num_partitions
            FROM bkpf
        UNION ALL SELECT 'BSEG', count(*), count(DISTINCT GJAHR) FROM bseg
        UNION ALL SELECT 'KNA1', count(*), count(DISTINCT LAND1) FROM kna1
        UNION ALL SELECT 'MARA', count(*), count(DISTINCT MTART) FROM mara
        UNION ALL SELECT 'VBAK', count(*), 0 FROM vbak UNION ALL SELECT 'VBAP', count(*), 0 FROM vbap
        UNION ALL SELECT 'LFA1', count(*), count(DISTINCT LAND1) FROM lfa1
        UNION ALL SELECT 'EKKO', count(*), count(DISTINCT BUKRS) FROM ekko""",
    "create_if_missing": """SELECT 0 AS attempt, 'created' AS state, count(*) AS num_rows FROM orders
        UNION ALL SELECT 1, 'existing', count(*) FROM orders""",
    "write_partitioned": "SELECT GJAHR, count(*) AS num_rows FROM bkpf GROUP BY GJAHR",
    "filter_partition": "SELECT * FROM bkpf WHERE GJAHR = 2024",
    "ctas_documented": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{text}' AS comment, count({c}) AS filled FROM vbak"
        for c, text in COMMENTS.items()
    ),
    "append_strict": "SELECT 2 * count(*) AS num_rows, 'rejected' AS drifted FROM bkpf",
    "land_batch": f"SELECT * FROM ({TEXT_ORDERS}) ORDER BY VBELN DESC LIMIT 50",
    "incremental_files": """SELECT 1 AS run, count(*) AS total_rows FROM vbak WHERE AUART <> '1-URGENT'
        UNION ALL SELECT 2, count(*) FROM vbak WHERE AUART <> '1-URGENT' UNION ALL SELECT 3, count(*) FROM vbak""",
    "file_lineage_columns": """SELECT 'lineitem' AS source_table, count(*) AS num_rows,
        count(DISTINCT l_orderkey) AS orders FROM lineitem""",
    "rescue_unknown": f"""SELECT *, NULL AS _rescued_data FROM ({TEXT_ORDERS}) WHERE VTWEG <> 'F'
        UNION ALL SELECT VBELN, ERDAT, KUNNR, NULL, NULL, NULL,
            CASE WHEN AUART IS DISTINCT FROM '1-URGENT' THEN NETWR END, WAERK, AUART,
            CASE WHEN AUART = '1-URGENT' THEN '{{"NETWR":"n/a","ZZREGION_NUEVA":"' ELSE '{{"ZZREGION_NUEVA":"' END
            || SPART || '"}}' FROM ({TEXT_ORDERS}) WHERE VTWEG = 'F'""",
    "rescue_monitor": """SELECT count(*) AS total_rows, count(*) FILTER (WHERE VTWEG = 'F') AS rescued_rows
        FROM vbak""",
    "stream_table_read": "SELECT *, 'orders' AS _source FROM orders",
}
