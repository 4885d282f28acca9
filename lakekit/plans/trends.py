"""Development over time and customer segments. Windows run over monthly rows, of which there are few."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions.money import QUANTITY, exact_sum, percent, ratio
from lakekit.operators.ranking import pareto_top_n, tiles_by_histogram
from lakekit.sources.workspace import written


def monthly_sales(orders: DataFrame) -> DataFrame:
    """Revenue (decimal) and orders per organisation and month."""
    return (
        orders.where(F.col("ERDAT").isNotNull())
        .groupBy(
            F.col("VKORG").alias("org_ventas"), F.year("ERDAT").alias("anio"), F.month("ERDAT").alias("mes")
        )
        .agg(exact_sum("NETWR").alias("ventas_mes"), F.count_distinct("VBELN").alias("num_ordenes"))
    )


def monthly_trend(orders: DataFrame) -> DataFrame:
    """Per organisation and month: revenue, the month before, change in percent, and running sum of the year."""
    in_order = Window.partitionBy("org_ventas").orderBy("anio", "mes")
    in_year = (
        Window.partitionBy("org_ventas", "anio")
        .orderBy("mes")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before, now = F.col("_before"), F.col("ventas_mes")
    return (
        monthly_sales(orders)
        .withColumns(
            {"_before": F.lag("ventas_mes", 1).over(in_order), "_ytd": F.sum("ventas_mes").over(in_year)}
        )
        .select(
            "anio",
            "mes",
            "org_ventas",
            now.cast("double").alias("ventas_mes"),
            "num_ordenes",
            before.cast("double").alias("ventas_mes_anterior"),
            percent(now - before, before).alias("variacion_pct"),
            F.col("_ytd").cast("double").alias("ventas_ytd"),
        )
    )


def moving_average(orders: DataFrame, months: int = 3) -> DataFrame:
    """Mean revenue of the last months per organisation; shorter at the start."""
    frame = Window.partitionBy("org_ventas").orderBy("anio", "mes").rowsBetween(-(months - 1), 0)
    rolling = ratio(F.sum("ventas_mes").over(frame), F.count("ventas_mes").over(frame))
    return monthly_sales(orders).select(
        "anio",
        "mes",
        "org_ventas",
        F.col("ventas_mes").cast("double").alias("ventas_mes"),
        rolling.alias("media_movil"),
    )


def material_pareto(lines: DataFrame, materials: DataFrame, n: int = 5) -> DataFrame:
    """Best materials of each category with share and running share. Lines are summed before the join."""
    sold = lines.groupBy("MATNR").agg(
        exact_sum("NETWR").alias("revenue_total"), F.sum(F.col("KWMENG").cast(QUANTITY)).alias("unidades_vendidas")
    )
    per_material = materials.select(
        "MATNR", F.col("MATKL").alias("categoria"), F.col("MTART").alias("tipo_material")
    ).join(sold, "MATNR")
    best = pareto_top_n(per_material, "categoria", "revenue_total", "MATNR", n)
    return best.withColumns(
        {
            "revenue_total": F.col("revenue_total").cast("double"),
            "unidades_vendidas": F.round("unidades_vendidas", 2).cast("double"),
        }
    )


def rfm_metrics(orders: DataFrame, as_of: date) -> DataFrame:
    """Days since the last order, orders and revenue per customer."""
    return (
        orders.where(F.col("ERDAT").isNotNull())
        .groupBy("KUNNR")
        .agg(
            F.datediff(F.lit(as_of), F.max("ERDAT")).alias("recency_days"),
            F.count_distinct("VBELN").alias("frequency"),
            exact_sum("NETWR").alias("monetary"),
        )
    )


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Marketing segment of the three scores (1 worst, 5 best)."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 4) & (f <= 2), "New")
        .when((r <= 2) & (f >= 4), "At risk")
        .when((r <= 2) & (f <= 2), "Lost")
        .otherwise("Regular")
    )


def rfm_segments(orders: DataFrame, as_of: date) -> DataFrame:
    """Quintile scores and segment of every customer; ties are ordered by customer.

    The customers' metrics are stored once; histograms over them give the quintiles' exact edges.
    """
    metrics = written(rfm_metrics(orders, as_of), "rfm-metrics")
    scored = tiles_by_histogram(
        metrics,
        5,
        {
            "r_score": -F.col("recency_days"),
            "f_score": F.col("frequency"),
            "m_score": F.col("monetary") * 100,
        },
        "KUNNR",
    )
    segment = rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    return scored.withColumns({"segment": segment, "monetary": F.col("monetary").cast("double")})


def forecast_features(orders: DataFrame) -> DataFrame:
    """Model inputs per organisation and month on a calendar without gaps: lags, rolling mean and deviation."""
    sales = monthly_sales(orders).select(
        "org_ventas", F.make_date("anio", "mes", F.lit(1)).alias("month"), F.col("ventas_mes").alias("_sales")
    )
    calendar = sales.groupBy("org_ventas").agg(
        F.explode(F.sequence(F.min("month"), F.max("month"), F.expr("interval 1 month"))).alias("month")
    )
    dense = calendar.join(sales, ["org_ventas", "month"], "left").withColumn(
        "_sales", F.coalesce("_sales", F.lit(0).cast("decimal(28,2)"))
    )
    in_order = Window.partitionBy("org_ventas").orderBy("month")
    last_three = in_order.rowsBetween(-2, 0)
    sales_value = F.col("_sales").cast("double")
    return dense.select(
        "org_ventas",
        "month",
        (F.row_number().over(in_order) - 1).alias("month_index"),
        sales_value.alias("sales"),
        *[F.lag(sales_value, k).over(in_order).alias(f"lag_{k}") for k in (1, 3, 12)],
        ratio(F.sum("_sales").over(last_three), F.count("_sales").over(last_three)).alias("rolling_mean_3"),
        F.round(F.stddev_samp(sales_value).over(last_three), 2).alias("rolling_std_3"),
    )
