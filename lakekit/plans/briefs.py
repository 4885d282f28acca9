"""Texts composed from results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.columns import labelled_text
from lakekit.operators.cleaning import top_k
from lakekit.plans.gold import customer_abc


def customer_brief(orders: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """One text per top customer from its metrics."""
    best = top_k(customer_abc(orders, customers), "revenue_total", n, "KUNNR")
    facts = labelled_text(
        {
            "Cliente": "nombre_cliente",
            "País": "pais",
            "Ciudad": "ciudad",
            "Revenue total": F.col("revenue_total").cast("decimal(18,0)"),
            "Órdenes": "total_ordenes",
            "Clasificación": "clasificacion_abc",
            "Ticket promedio": F.col("ticket_promedio").cast("decimal(18,0)"),
        }
    )
    return best.select(
        "KUNNR",
        "nombre_cliente",
        "pais",
        "revenue_total",
        "total_ordenes",
        "clasificacion_abc",
        facts.alias("resumen_ejecutivo"),
    )
