"""Usage and cost reports over a metering table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.money import QUANTITY, money
from lakekit.operators.cleaning import top_k
from lakekit.operators.joins import join_validity
from lakekit.values import NO_TAG


def month_to_date(usage: DataFrame, as_of: date) -> DataFrame:
    """Usage since the first of the month; the bound is a constant, so it reaches the scan."""
    return usage.where(
        (F.col("usage_date") >= F.lit(as_of.replace(day=1))) & (F.col("usage_date") <= F.lit(as_of))
    )


def usage_by_tag(usage: DataFrame, as_of: date, tag: str = "proyecto") -> DataFrame:
    """Quantity per project tag, product and unit."""
    return (
        month_to_date(usage, as_of)
        .groupBy(
            F.coalesce(F.try_element_at("custom_tags", F.lit(tag)), F.lit(NO_TAG)).alias("proyecto"),
            F.col("billing_origin_product").alias("producto"),
            "usage_unit",
        )
        .agg(F.round(F.sum(F.col("usage_quantity").cast(QUANTITY)), 2).cast("double").alias("consumo"))
    )


def usage_cost(usage: DataFrame, prices: DataFrame, as_of: date) -> DataFrame:
    """Quantity and cost per product, each use priced as listed at its time."""
    priced = join_validity(
        month_to_date(usage, as_of), prices, "sku_name", "usage_start_time", "price_start_time", "price_end_time"
    )
    quantity = F.col("usage_quantity").cast(QUANTITY)
    price = F.col("pricing.default").cast("decimal(10,4)")
    return priced.groupBy(F.col("billing_origin_product").alias("producto"), "sku_name").agg(
        F.round(F.sum(quantity), 3).cast("double").alias("unidades"),
        F.round(F.sum(quantity * price), 2).cast("double").alias("costo_usd"),
    )


def usage_daily(usage: DataFrame, unit: str, n: int = 15) -> DataFrame:
    """Quantity of one unit per day and product, the latest rows."""
    daily = (
        usage.where(F.col("usage_unit") == unit)
        .groupBy("usage_date", "sku_name")
        .agg(F.sum(money("usage_quantity")).cast("double").alias("dsus"))
    )
    return top_k(daily, "usage_date", n, "sku_name")
