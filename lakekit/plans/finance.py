"""Accounting summaries, budget comparison and currency conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.columns import labelled_text
from lakekit.functions.money import exact_sum, money, percent, ratio, total
from lakekit.operators.cleaning import top_k
from lakekit.operators.joins import join_lookup
from lakekit.values import BUDGET_STATUS, BUDGET_STATUS_LOWEST, HIGH_VALUE_AMOUNT

DOCUMENT_KEYS = ("BUKRS", "BELNR", "GJAHR")


def lines_per_document(lines: DataFrame) -> DataFrame:
    """Lines and amount of each document. Runs before any join: one row per document is left to match."""
    return lines.groupBy(*DOCUMENT_KEYS).agg(
        F.count("BUZEI").alias("_lines"),
        F.count("DMBTR").alias("_amounts"),
        exact_sum("DMBTR").alias("_amount"),
    )


def _line_measures() -> list[Column]:
    amount, amounts = F.sum("_amount"), F.sum("_amounts")
    return [
        F.sum("_lines").alias("num_lines"),
        F.round(amount, 2).cast("double").alias("total_amount"),
        ratio(amount, amounts).alias("avg_amount"),
    ]


def doc_line_summary(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Documents, lines and amounts per company, year and currency."""
    return (
        headers.join(lines_per_document(lines), list(DOCUMENT_KEYS))
        .groupBy("BUKRS", "GJAHR", "WAERK")
        .agg(F.count_distinct("BELNR").alias("num_documents"), *_line_measures())
    )


def fin_summary(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """The same for valid headers, with the users who posted them.

    Silver headers are unique by key, so their documents are counted without a distinct.
    """
    return (
        headers.where("_is_valid")
        .join(lines_per_document(lines), list(DOCUMENT_KEYS))
        .groupBy(
            F.col("BUKRS").alias("company_code"),
            F.col("GJAHR").alias("fiscal_year"),
            F.col("WAERK").alias("currency"),
        )
        .agg(
            F.count("BELNR").alias("num_documents"),
            F.count_distinct("USNAM").alias("num_users"),
            *_line_measures(),
        )
    )


def doc_metrics_top(headers: DataFrame, lines: DataFrame, years: Sequence[int], n: int = 20) -> DataFrame:
    """Largest documents of some years with their line count, amount and mean."""
    chosen = headers.where(F.col("GJAHR").isin(list(years))).select(*DOCUMENT_KEYS, "WAERK", "USNAM")
    measured = chosen.join(
        lines_per_document(lines.where(F.col("GJAHR").isin(list(years)))), list(DOCUMENT_KEYS)
    ).select(
        F.col("BUKRS").alias("sociedad"),
        F.col("GJAHR").alias("ejercicio"),
        F.col("BELNR").alias("documento"),
        F.col("WAERK").alias("moneda"),
        F.col("USNAM").alias("usuario"),
        F.col("_lines").alias("num_lineas"),
        F.col("_amount").cast("double").alias("monto_total"),
        ratio(F.col("_amount"), F.col("_amounts")).alias("monto_promedio"),
    )
    return top_k(measured, "monto_total", n, "documento")


DOC_TYPE_REPORT = """
    SELECT h.BLART AS tipo_doc,
           count(DISTINCT h.BELNR) AS num_documentos,
           CAST(sum(l.amount) AS double) AS monto_total,
           CAST(round(sum(l.amount) / CAST(sum(l.amounts) AS decimal(20,0)), 2) AS double) AS monto_promedio
    FROM {headers} h JOIN {lines} l USING (BUKRS, BELNR, GJAHR)
    WHERE h.BUKRS = :company AND h.GJAHR = :fiscal_year AND h.WAERK = :currency
    GROUP BY h.BLART
"""


def doc_type_report(
    spark: SparkSession, headers: DataFrame, lines: DataFrame, company: str, fiscal_year: int, currency: str
) -> DataFrame:
    """Documents and amounts per type for one company, year and currency; values are bound, not pasted."""
    amounts = lines_per_document(lines).withColumnsRenamed({"_amount": "amount", "_amounts": "amounts"})
    return spark.sql(
        DOC_TYPE_REPORT,
        args={"company": company, "fiscal_year": fiscal_year, "currency": currency},
        headers=headers,
        lines=amounts,
    )


def account_prefix_totals(lines: DataFrame, prefix: str) -> DataFrame:
    """Lines and amount of the accounts that start with a prefix."""
    return lines.where(F.col("KONTO").startswith(prefix)).agg(
        F.count(F.lit(1)).alias("num_lines"), total("DMBTR").alias("total_amount")
    )


def high_value_documents(headers: DataFrame, lines: DataFrame, above: float = HIGH_VALUE_AMOUNT) -> DataFrame:
    """Lines above an amount with their header, a text for the reviewer and a rule-based alert."""
    high = lines.where(F.col("DMBTR") > above)
    joined = headers.join(high, list(DOCUMENT_KEYS)).withColumn("monto", money("DMBTR"))
    alert = (
        F.when(F.col("monto") > 2 * above, "Revisar: monto muy alto")
        .when(F.col("WAERK") != "COP", "Revisar: moneda extranjera")
        .otherwise("Sin anomalías detectadas.")
    )
    described = labelled_text(
        {"Sociedad": "BUKRS", "Clase documento": "BLART", "Moneda": "WAERK", "Monto": "monto"}
    )
    return joined.select(
        *DOCUMENT_KEYS,
        "BUZEI",
        "BLART",
        "WAERK",
        F.col("monto").cast("double").alias("monto"),
        described.alias("descripcion"),
        alert.alias("alerta_auditoria"),
    )


BUDGET_KEYS = ("year", "month", "sales_org", "currency")


def actual_vs_budget(actual: DataFrame, budget: DataFrame) -> DataFrame:
    """Revenue against budget per month, organisation and currency, with a status by attainment."""
    real, planned = money("total_revenue"), money("budget_revenue")
    status = F.lit(BUDGET_STATUS_LOWEST)
    for share, label in sorted(BUDGET_STATUS):
        status = F.when(real * 100 >= planned * share, F.lit(label)).otherwise(status)
    return actual.join(budget, list(BUDGET_KEYS)).select(
        *BUDGET_KEYS,
        F.col("num_orders").alias("ordenes_reales"),
        F.col("total_revenue").alias("ventas_reales"),
        F.col("budget_orders").alias("ordenes_budget"),
        F.col("budget_revenue").alias("ventas_budget"),
        F.col("scenario").alias("escenario"),
        (real - planned).cast("double").alias("varianza"),
        percent(real - planned, planned, 1).alias("varianza_pct"),
        status.alias("estado"),
    )


def revenue_normalised(actual: DataFrame, rates: DataFrame) -> DataFrame:
    """Revenue in local currency by the rate of its month; NULL where a needed rate or currency is missing."""
    with_rates = join_lookup(
        actual,
        rates,
        ["year", "month"],
        {"tasa_usd_cop": F.col("tasa_usd_cop"), "tasa_eur_cop": F.col("tasa_eur_cop")},
    )
    revenue = money("total_revenue")
    local = (
        F.when(F.col("currency") == "COP", revenue)
        .when(F.col("currency") == "USD", revenue * money("tasa_usd_cop"))
        .when(F.col("currency") == "EUR", revenue * money("tasa_eur_cop"))
    )
    return with_rates.select(
        *BUDGET_KEYS,
        F.col("total_revenue").alias("ventas_moneda_original"),
        F.round(local, 2).cast("double").alias("ventas_cop"),
        "tasa_usd_cop",
        "tasa_eur_cop",
    )
