"""Jobs chained from arriving data to result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.functions.columns import pad_key, parse_yyyymmdd, safe_ratio
from lakekit.functions.money import exact_sum, mean, total
from lakekit.operators.changes import insert_new_only
from lakekit.operators.cleaning import dedup_by_key
from lakekit.operators.partials import FAN, PartialTable
from lakekit.operators.quality import expect_drop
from lakekit.schemas import ERP_SCHEMAS
from lakekit.streaming.ingest import incremental_files, read_batches, stream_table_read, write_batch


def facts_silver(bronze: DataFrame) -> DataFrame:
    """Typed facts with a per-row ratio and date parts; rows without a zone are dropped.

    The other two expectations only warn: their rows stay.
    """
    kept = expect_drop(bronze, {"zone_valid": F.col("zone").isNotNull()})
    return kept.select(
        "zone",
        "amount",
        "distance",
        safe_ratio("amount", "distance").alias("amount_per_distance"),
        F.col("happened_at").cast("date").alias("fact_date"),
        F.year("happened_at").alias("year"),
        F.month("happened_at").alias("month"),
        "_ingested_at",
    )


def zone_kpis(silver: DataFrame) -> DataFrame:
    """Facts per zone and month."""
    return silver.groupBy("zone", "year", "month").agg(
        F.count(F.lit(1)).alias("num_facts"),
        total("amount").alias("revenue_total"),
        mean("amount").alias("ticket_promedio"),
        mean("distance").alias("distancia_promedio"),
    )


def stream_bronze_silver_gold(
    spark: SparkSession, folder: str, schema: T.StructType, shape, source: str, work: str, name_pattern: str = "*.parquet"
) -> DataFrame:
    """Table stream to bronze files, bronze stream to silver files, and the aggregate over silver.

    `shape` turns the bronze rows into facts (zone, amount, distance, happened_at). Each stage has its own
    checkpoint: a second call takes only what is new.
    """
    bronze, silver = f"{work}/bronze", f"{work}/silver"
    stream_table_read(spark, folder, schema, source, bronze, f"{work}/checkpoints/bronze", name_pattern)
    stored = spark.read.parquet(bronze).schema
    (
        facts_silver(shape(spark.readStream.schema(stored).parquet(bronze)))
        .writeStream.format("parquet")
        .option("path", silver)
        .option("checkpointLocation", f"{work}/checkpoints/silver")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return zone_kpis(spark.read.parquet(silver))


def orders_from_landing(bronze: DataFrame) -> DataFrame:
    """Landed order rows in the form of the silver table."""
    return bronze.select(
        pad_key("VBELN").alias("VBELN"),
        parse_yyyymmdd("ERDAT").alias("ERDAT"),
        "AUART",
        pad_key("KUNNR").alias("KUNNR"),
        "VKORG",
        "NETWR",
        "WAERK",
    )


def sales_of_batch(orders: DataFrame) -> DataFrame:
    """Orders and revenue per month, organisation and currency."""
    return orders.groupBy(
        F.year("ERDAT").alias("year"),
        F.month("ERDAT").alias("month"),
        F.col("VKORG").alias("sales_org"),
        F.col("WAERK").alias("currency"),
    ).agg(F.count(F.lit(1)).alias("num_orders"), total("NETWR").alias("total_revenue"))


# The sales table as one that batches are merged into.
EMPTY_SALES = (
    "year int, month int, sales_org string, currency string, num_orders bigint, total_revenue double, "
    "avg_order_value double"
)
SALES_KEYS = ("year", "month", "sales_org", "currency")
SALES_PARTIALS = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("sales_org", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("num_orders", T.LongType()),
        T.StructField("revenue", T.DecimalType(38, 2)),
    ]
)


def partial_sales(orders: DataFrame) -> DataFrame:
    """Orders and exact revenue per month, organisation and currency: adds up over batches."""
    return orders.groupBy(
        F.year("ERDAT").alias("year"),
        F.month("ERDAT").alias("month"),
        F.col("VKORG").alias("sales_org"),
        F.col("WAERK").alias("currency"),
    ).agg(F.count(F.lit(1)).alias("num_orders"), exact_sum("NETWR").cast("decimal(38,2)").alias("revenue"))


def finished_sales(partials: DataFrame) -> DataFrame:
    """The sales table from its added-up partial values."""
    return partials.select(
        *SALES_KEYS,
        "num_orders",
        F.col("revenue").cast("double").alias("total_revenue"),
        F.when(F.col("num_orders") > 0, F.col("revenue").cast("double") / F.col("num_orders"))
        .otherwise(F.lit(0.0))
        .alias("avg_order_value"),
    )


@dataclass(frozen=True)
class OrderLoad:
    """Folders of the chain landing files -> bronze -> new silver orders -> accumulated sales.

    `fan` is the number of batches after which their sales are folded together.
    """

    landing: str
    work: str
    fan: int = FAN

    @property
    def bronze(self) -> str:
        return f"{self.work}/orders_bronze"

    @property
    def silver(self) -> str:
        return f"{self.work}/orders_silver"

    @property
    def sales(self) -> PartialTable:
        merges = {"num_orders": F.sum, "revenue": F.sum}
        return PartialTable(f"{self.work}/gold_sales", SALES_PARTIALS, SALES_KEYS, merges, self.fan)

    def run(self, spark: SparkSession, name_pattern: str = "*.csv") -> None:
        """Take in what has landed since the last run.

        Every step of a micro-batch replaces only its own output: bronze, silver and the batch's own sales under the batch
        number. What is written follows the batch, not the tables: the sales table is added up when it is read. A batch
        that is run again after a failure starts from the silver orders before it, gives the same tables and adds nothing
        twice.
        """
        incremental_files(
            spark,
            self.landing,
            ERP_SCHEMAS["VBAK"],
            f"{self.work}/checkpoints/orders",
            name_pattern=name_pattern,
            on_batch=self._batch,
        )

    def _batch(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        write_batch(rows, self.bronze, batch_id)
        landed = spark.read.parquet(f"{self.bronze}/_batch={batch_id}")
        candidates = dedup_by_key(orders_from_landing(landed), ["VBELN"])
        known = read_batches(spark, self.silver, candidates.schema).where(F.col("_batch") < batch_id)
        write_batch(insert_new_only(known, candidates, ["VBELN"]), self.silver, batch_id)
        added = spark.read.schema(candidates.schema).parquet(f"{self.silver}/_batch={batch_id}")
        self.sales.add(partial_sales(added), batch_id)

    def current_sales(self, spark: SparkSession, after: int | None = None) -> DataFrame:
        """The sales table after the newest batch, or as it was after an earlier one."""
        return finished_sales(self.sales.read(spark, after))
