"""ERP tables (accounting, sales, masters) as views over the given order, line and master tables.

Each function returns one ERP table as it stands in the bronze layer: keys and codes as text, amounts as doubles.
Only the columns a job selects are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.columns import pad_key

# Order types of the given orders that count as returns.
RETURN_TYPES = ("4-NOT SPECIFIED", "5-LOW")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _currency(order_key: str) -> Column:
    remainder = F.col(order_key) % 3
    return F.when(remainder == 0, "COP").when(remainder == 1, "USD").otherwise("EUR")


def _sales_org(customer_key: str) -> Column:
    return (F.lit(1000) * (F.col(customer_key) % 3 + 1)).cast("string")


def vbak(spark: SparkSession, folder: str) -> DataFrame:
    """Order headers as extracted: dates as yyyyMMdd text."""
    return order_headers(spark, folder).withColumn("ERDAT", F.date_format("ERDAT", "yyyyMMdd"))


def order_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Order headers with padded keys and typed dates, so that filters on dates reach the scan."""
    return read_table(spark, folder, "orders").select(
        pad_key("o_orderkey").alias("VBELN"),
        F.col("o_orderdate").cast("date").alias("ERDAT"),
        pad_key("o_custkey").alias("KUNNR"),
        _sales_org("o_custkey").alias("VKORG"),
        F.col("o_orderstatus").alias("VTWEG"),
        F.lpad((F.col("o_orderkey") % 5 + 1).cast("string"), 2, "0").alias("SPART"),
        F.col("o_totalprice").alias("NETWR"),
        _currency("o_orderkey").alias("WAERK"),
        F.col("o_orderpriority").alias("AUART"),
    )


def vbap(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines."""
    return read_table(spark, folder, "lineitem").select(
        pad_key("l_orderkey").alias("VBELN"),
        pad_key("l_linenumber", 6).alias("POSNR"),
        pad_key("l_partkey").alias("MATNR"),
        F.col("l_quantity").alias("KWMENG"),
        F.col("l_extendedprice").alias("NETWR"),
        _currency("l_orderkey").alias("WAERK"),
        F.col("l_returnflag").alias("MEINS"),
        F.col("l_linestatus").alias("WERKS"),
    )


def _document_keys(order_key: str) -> list[Column]:
    """Company, document and fiscal year. All follow from the document number, so that lines, which carry nothing
    else of their header, have the same three keys without a lookup."""
    number = F.col(order_key)
    return [
        (F.lit(1000) * (number % 7 % 3 + 1)).cast("string").alias("BUKRS"),
        pad_key(order_key).alias("BELNR"),
        (F.lit(2020) + number % 5).cast("int").alias("GJAHR"),
    ]


def bkpf(spark: SparkSession, folder: str) -> DataFrame:
    """Accounting headers; the fiscal year is a number, document and user are text."""
    posted = F.date_format(F.col("o_orderdate").cast("date"), "yyyyMMdd")
    return read_table(spark, folder, "orders").select(
        *_document_keys("o_orderkey"),
        posted.alias("BLDAT"),
        posted.alias("BUDAT"),
        F.substring("o_orderpriority", 1, 1).alias("BLART"),
        _currency("o_orderkey").alias("WAERK"),
        F.concat(F.lit(" user"), (F.col("o_custkey") % 50).cast("string"), F.lit(" ")).alias("USNAM"),
        F.col("o_orderpriority").alias("BKTXT"),
    )


def bseg(spark: SparkSession, folder: str) -> DataFrame:
    """Accounting lines."""
    return read_table(spark, folder, "lineitem").select(
        *_document_keys("l_orderkey"),
        pad_key("l_linenumber", 3).alias("BUZEI"),
        F.col("l_partkey").cast("string").alias("KONTO"),
        F.col("l_extendedprice").alias("DMBTR"),
    )


def kna1(spark: SparkSession, folder: str) -> DataFrame:
    """Customers."""
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customers = read_table(spark, folder, "customer")
    return customers.join(
        nations, customers.c_nationkey == nations.n_nationkey, "left"
    ).select(
        pad_key("c_custkey").alias("KUNNR"),
        F.col("c_name").alias("NAME1"),
        F.col("n_name").alias("LAND1"),
        F.concat(F.lit("City "), F.col("n_regionkey").cast("string")).alias("ORT01"),
        F.col("c_mktsegment").alias("BRSCH"),
        F.lit("KUNA").alias("KTOKD"),
    )


def mara(spark: SparkSession, folder: str) -> DataFrame:
    """Materials."""
    return read_table(spark, folder, "part").select(
        pad_key("p_partkey").alias("MATNR"),
        F.col("p_type").alias("MTART"),
        F.col("p_brand").alias("MATKL"),
        F.col("p_name").alias("MAKTX"),
    )


def lfa1(spark: SparkSession, folder: str) -> DataFrame:
    """Vendors."""
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    suppliers = read_table(spark, folder, "supplier")
    return suppliers.join(
        nations, suppliers.s_nationkey == nations.n_nationkey, "left"
    ).select(
        pad_key("s_suppkey").alias("LIFNR"),
        F.col("s_name").alias("NAME1"),
        F.col("n_name").alias("LAND1"),
    )


def ekko(spark: SparkSession, folder: str) -> DataFrame:
    """Purchase headers: one per supplied line."""
    return read_table(spark, folder, "lineitem").select(
        pad_key("l_orderkey").alias("EBELN"),
        F.col("l_linestatus").alias("BUKRS"),
        pad_key("l_suppkey").alias("LIFNR"),
        F.col("l_extendedprice").alias("NETWR"),
        _currency("l_orderkey").alias("WAERS"),
    )


ERP_TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "BKPF": bkpf,
    "BSEG": bseg,
    "KNA1": kna1,
    "MARA": mara,
    "VBAK": vbak,
    "VBAP": vbap,
    "LFA1": lfa1,
    "EKKO": ekko,
}
