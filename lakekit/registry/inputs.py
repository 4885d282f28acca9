"""Inputs shared by the registered queries, all derived from the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.columns import moment
from lakekit.functions.money import money
from lakekit.operators.changes import update_where
from lakekit.operators.history import write_version
from lakekit.plans import gold, silver
from lakekit.sources import erp
from lakekit.sources.workspace import fresh_dir

# Class limits that split the given customers over all four classes.
CLASS_LIMITS = ((3_000_000, "A - Strategic"), (2_000_000, "B - Key Account"), (1_000_000, "C - Standard"))
SPLIT_TIERS = ((3_000_000, "PLATINUM"), (2_000_000, "GOLD"), (1_000_000, "SILVER"))
AS_OF_YEAR = 2003
COMMIT_TIMES = (datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1))
CLOCK = datetime(2024, 6, 1, 8)


def gold_orders(spark: SparkSession, d: str) -> DataFrame:
    return gold.orders_gold(erp.order_headers(spark, d), erp.RETURN_TYPES)


def silver_customers(spark: SparkSession, d: str) -> DataFrame:
    return silver.customers_silver(erp.kna1(spark, d))


def silver_lines(spark: SparkSession, d: str) -> DataFrame:
    return silver.lines_silver(erp.vbap(spark, d), erp.mara(spark, d))


def gold_customers(spark: SparkSession, d: str) -> DataFrame:
    return gold.customers_gold(
        silver_customers(spark, d), erp.order_headers(spark, d), AS_OF_YEAR, erp.RETURN_TYPES, CLASS_LIMITS
    )


def gold_materials(spark: SparkSession, d: str) -> DataFrame:
    return gold.materials_gold(silver_lines(spark, d), erp.order_headers(spark, d))


def customer_360(spark: SparkSession, d: str) -> DataFrame:
    return gold.customer_360(silver_customers(spark, d), erp.order_headers(spark, d))


def tiered_customers(spark: SparkSession, d: str) -> DataFrame:
    """Customers with tiers whose limits split the given customers."""
    return gold.customer_360(silver_customers(spark, d), erp.order_headers(spark, d), SPLIT_TIERS)


def monthly_kpis(spark: SparkSession, d: str) -> DataFrame:
    return gold.sales_kpis_monthly(erp.order_headers(spark, d))


def budget(spark: SparkSession, d: str) -> DataFrame:
    """A budget around the actual revenue: its factor changes with the month, so that every status occurs."""
    month = F.col("month") % 4
    factor = F.when(month == 0, "0.95").when(month == 1, "1.05").when(month == 2, "1.20").otherwise("1.60")
    return monthly_kpis(spark, d).select(
        "year",
        "month",
        "sales_org",
        "currency",
        F.round(money("total_revenue") * factor.cast("decimal(3,2)"), 2).cast("double").alias("budget_revenue"),
        (F.col("num_orders") + 1).cast("int").alias("budget_orders"),
        F.when(month == 3, "OPTIMISTA").otherwise("BASE").alias("scenario"),
    )


def fx_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rates for three months of every year with orders: the other months have none."""
    ordered = F.col("o_orderdate")
    years = erp.read_table(spark, d, "orders").select(F.year(ordered).alias("year"), F.month(ordered).alias("month"))
    return (
        years.where(F.col("month").isin(1, 6, 12))
        .distinct()
        .select(
            "year",
            "month",
            ((F.col("year") - 1995) * 100 + 3400 + F.col("month") * 0.25).cast("double").alias("tasa_usd_cop"),
            ((F.col("year") - 1995) * 100 + 3900 + F.col("month") * 0.5).cast("double").alias("tasa_eur_cop"),
        )
    )


def usage(spark: SparkSession, d: str) -> DataFrame:
    """Metering rows: one per event."""
    k = F.get_json_object("props", "$.k").cast("int")
    tagged = F.create_map(F.lit("proyecto"), F.concat(F.lit("p"), (k % 10).cast("string")))
    return erp.read_table(spark, d, "events").select(
        F.col("ts").cast("date").alias("usage_date"),
        F.col("ts").alias("usage_start_time"),
        F.col("event_type").alias("sku_name"),
        F.concat(F.lit("product-"), F.col("event_type")).alias("billing_origin_product"),
        F.when(F.col("event_type").isin("error", "signup"), "DSU").otherwise("DBU").alias("usage_unit"),
        F.col("value").alias("usage_quantity"),
        F.when(k < 50, tagged).otherwise(F.create_map().cast("map<string,string>")).alias("custom_tags"),
    )


def prices(spark: SparkSession, d: str) -> DataFrame:
    """Two price periods per product, the second one open."""
    products = erp.read_table(spark, d, "events").select(F.col("event_type").alias("sku_name")).distinct()
    base = F.length("sku_name") * F.lit(0.1)
    change = moment(datetime(2024, 1, 16))

    def period(start, end, price):
        return F.struct(
            start.alias("start"), end.alias("end"), price.cast("decimal(10,4)").cast("double").alias("default")
        )

    both = F.array(
        period(moment(datetime(2023, 1, 1)), change, base),
        period(change, F.lit(None).cast("timestamp_ntz"), base + 0.05),
    )
    return products.select("sku_name", F.explode(both).alias("p")).select(
        "sku_name",
        F.col("p.start").alias("price_start_time"),
        F.col("p.end").alias("price_end_time"),
        F.struct(F.col("p.default").alias("default")).alias("pricing"),
    )


def customer_states(spark: SparkSession, d: str) -> list[DataFrame]:
    """Three states of a customer table: as given; one segment damaged; debtors gone and suppliers added."""
    first = erp.read_table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    second = update_where(first, F.col("c_mktsegment") == "BUILDING", {"c_mktsegment": F.lit("XXX")})
    suppliers = erp.read_table(spark, d, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),  # no customer has a negative key
        F.lit("SUPPLIER").alias("c_mktsegment"),
        F.col("s_acctbal").alias("c_acctbal"),
    )
    return [first, second, second.where(F.col("c_acctbal") >= 0).unionByName(suppliers)]


def customer_history(spark: SparkSession, d: str) -> str:
    """The three states stored as versions 0, 1 and 2, the later ones as change sets; returns the table's path."""
    path = fresh_dir(spark, "customer-history")
    for version, (state, operation) in enumerate(zip(customer_states(spark, d), ("CREATE", "UPDATE", "MERGE"))):
        write_version(state, path, version, operation, COMMIT_TIMES[version], ["c_custkey"])
    return path
