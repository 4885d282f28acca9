"""Gold layer: sales, customers and materials."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.columns import active_since, is_return, pad_key, period_label
from lakekit.functions.money import MONEY, QUANTITY, exact_sum, graded, mean, money, percent, ratio, total
from lakekit.operators.cleaning import top_k
from lakekit.operators.distinct import count_numbered, distinct_bits, join_groups, number_of_bits
from lakekit.operators.joins import join_master
from lakekit.values import ABC_LIMITS, ABC_LOWEST, ORDER_BUSINESS_NAMES, RETURN_TYPES, TIER_LIMITS, TIER_LOWEST


def orders_gold(silver: DataFrame, return_types: Iterable[str] = RETURN_TYPES) -> DataFrame:
    """Orders under business names with year, month and return flag."""
    return silver.select(
        *[F.col(c).alias(name) for c, name in ORDER_BUSINESS_NAMES.items()],
        F.col("NETWR").cast(MONEY).cast("double").alias("valor_neto"),
        F.year("ERDAT").alias("anio_creacion"),
        F.month("ERDAT").alias("mes_creacion"),
        is_return("AUART", return_types).alias("es_devolucion"),
    )


def sales_by_org_currency(orders: DataFrame) -> DataFrame:
    return orders.groupBy("VKORG", "WAERK").agg(
        total("NETWR").alias("TOTAL_VENTAS"), F.count("VBELN").alias("NUM_ORDENES")
    )


def sales_kpis_monthly(orders: DataFrame) -> DataFrame:
    """Orders, customers and revenue per month, organisation and currency.

    Orders are counted by bitmaps that carry the amounts along, customers by bitmaps of their own.
    """
    keys = ["year", "month", "sales_org", "currency"]
    usable = orders.where(
        F.col("VBELN").isNotNull() & (F.col("NETWR") > 0) & F.col("ERDAT").isNotNull()
    ).select(
        F.year("ERDAT").alias("year"),
        F.month("ERDAT").alias("month"),
        F.col("VKORG").alias("sales_org"),
        F.col("WAERK").alias("currency"),
        "VBELN",
        "KUNNR",
        money("NETWR").alias("_amount"),
    )
    amounts = {"_sum": F.sum, "_count": F.count, "_max": F.max, "_min": F.min}
    by_order = distinct_bits(usable, keys, "VBELN", *[f("_amount").alias(n) for n, f in amounts.items()])
    sales = by_order.groupBy(*keys).agg(
        number_of_bits().alias("num_orders"),
        F.round(F.sum("_sum"), 2).cast("double").alias("total_revenue"),
        ratio(F.sum("_sum"), F.sum("_count")).alias("avg_order_value"),
        F.max("_max").cast("double").alias("max_order_value"),
        F.min("_min").cast("double").alias("min_order_value"),
    )
    counted = join_groups(sales, count_numbered(usable, keys, "KUNNR", "num_customers"), keys, "num_customers")
    return counted.select(
        *keys, "num_orders", "num_customers", "total_revenue", "avg_order_value", "max_order_value", "min_order_value"
    )


def abc_class(revenue: Column, limits: Sequence[tuple[float, str]] = ABC_LIMITS) -> Column:
    return graded(revenue, limits, ABC_LOWEST)


def customer_metrics(orders: DataFrame) -> DataFrame:
    """Orders, revenue and active years per customer.

    The distinct order count is the only distinct, so Spark combines all measures before the shuffle and spreads a
    customer with very many orders over several tasks by order number.
    """
    return (
        orders.where(F.col("ERDAT").isNotNull())
        .groupBy("KUNNR")
        .agg(
            F.count_distinct("VBELN").alias("total_ordenes"),
            total("NETWR").alias("revenue_total"),
            mean("NETWR").alias("ticket_promedio"),
            F.min(F.year("ERDAT")).alias("primer_anio"),
            F.max(F.year("ERDAT")).alias("ultimo_anio"),
        )
    )


def customer_abc(
    orders: DataFrame, customers: DataFrame, limits: Sequence[tuple[float, str]] = ABC_LIMITS
) -> DataFrame:
    """Customer metrics with master data and class; customers without a master row stay."""
    master = customers.select(
        F.col("KUNNR").alias("_customer"),
        F.col("NAME1").alias("nombre_cliente"),
        F.col("LAND1").alias("pais"),
        F.col("ORT01").alias("ciudad"),
    )
    return (
        join_master(customer_metrics(orders), master, "KUNNR", "_customer")
        .drop("_customer")
        .withColumn("clasificacion_abc", abc_class(F.col("revenue_total"), limits))
    )


def customers_gold(
    customers: DataFrame,
    orders: DataFrame,
    as_of_year: int,
    return_types: Iterable[str] = RETURN_TYPES,
    limits: Sequence[tuple[float, str]] = ABC_LIMITS,
) -> DataFrame:
    """Valid customers with their sales history, class and activity; customers without orders have zeros.

    Years and organisations per customer are few, so they are gathered as sets while the orders are counted, which
    avoids expanding every order row once per distinct count.
    """
    metrics = orders.groupBy(F.col("KUNNR").alias("codigo_cliente")).agg(
        F.count_distinct("VBELN").alias("total_ordenes"),
        total("NETWR").alias("revenue_total"),
        mean("NETWR").alias("ticket_promedio"),
        F.count_if(is_return("AUART", return_types)).alias("total_devoluciones"),
        F.size(F.collect_set(F.year("ERDAT"))).cast("bigint").alias("anios_activo"),
        F.min(F.year("ERDAT")).alias("primer_anio_compra"),
        F.max(F.year("ERDAT")).alias("ultimo_anio_compra"),
        F.size(F.collect_set("VKORG")).cast("bigint").alias("orgs_ventas_activas"),
    )
    zero_filled = (
        "total_ordenes",
        "revenue_total",
        "ticket_promedio",
        "total_devoluciones",
        "anios_activo",
        "orgs_ventas_activas",
    )
    return (
        customers.where("es_valido")
        .drop("grupo_cuentas")
        .join(metrics, "codigo_cliente", "left")
        .fillna(0, subset=list(zero_filled))
        .withColumns(
            {
                "clasificacion_abc": abc_class(F.col("revenue_total"), limits),
                "es_cliente_activo": active_since("ultimo_anio_compra", as_of_year),
            }
        )
    )


def abc_distribution(gold: DataFrame) -> DataFrame:
    return gold.groupBy("clasificacion_abc").agg(
        F.count(F.lit(1)).alias("clientes"), mean("revenue_total", 0).alias("revenue_promedio")
    )


def customer_360(
    customers: DataFrame, orders: DataFrame, limits: Sequence[tuple[float, str]] = TIER_LIMITS
) -> DataFrame:
    """Valid customers with orders, revenue, lifetime and tier.

    Orders are filtered and aggregated per customer before the join: the same rows as filters in the join
    condition, with one small row per customer to join.
    """
    usable = orders.where(
        F.col("VBELN").isNotNull() & (F.col("NETWR") > 0) & F.col("ERDAT").isNotNull()
    )
    metrics = usable.groupBy(F.col("KUNNR").alias("_customer")).agg(
        F.count_distinct("VBELN").alias("total_orders"),
        total("NETWR").alias("total_revenue"),
        mean("NETWR").alias("avg_order_value"),
        F.min("ERDAT").alias("first_order_date"),
        F.max("ERDAT").alias("last_order_date"),
    )
    return (
        customers.where("es_valido")
        .join(metrics, pad_key("codigo_cliente") == F.col("_customer"), "left")
        .select(
            F.col("codigo_cliente").alias("customer_id"),
            F.col("nombre_cliente").alias("customer_name"),
            F.col("pais").alias("country"),
            F.col("ciudad").alias("city"),
            F.col("sector_industria").alias("industry_sector"),
            F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
            "total_revenue",
            "avg_order_value",
            "first_order_date",
            "last_order_date",
            F.datediff("last_order_date", "first_order_date").alias("customer_lifetime_days"),
            graded(F.col("total_revenue"), limits, TIER_LOWEST).alias("customer_tier"),
        )
    )


def tier_rollup(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_tier").agg(
        F.count(F.lit(1)).alias("num_customers"), total("total_revenue").alias("revenue")
    )


def materials_gold(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Units and revenue per material, month, organisation and customer, from valid lines."""
    year, month = F.year("ERDAT"), F.month("ERDAT")
    dated = orders.where(F.col("ERDAT").isNotNull()).select("VBELN", "ERDAT", "VKORG", "KUNNR")
    return (
        lines.where("es_valido")
        .join(dated, F.col("numero_orden") == F.col("VBELN"))
        .groupBy(
            "codigo_material",
            "descripcion_material",
            "tipo_material",
            "categoria_material",
            year.alias("anio"),
            month.alias("mes"),
            F.col("VKORG").alias("org_ventas"),
            F.col("KUNNR").alias("codigo_cliente"),
        )
        .agg(
            F.count_distinct("numero_orden").alias("total_ordenes"),
            F.round(F.sum(F.col("cantidad").cast(QUANTITY)), 2).cast("double").alias("unidades_vendidas"),
            total("valor_neto").alias("revenue_total"),
        )
        .withColumn("periodo", period_label("anio", "mes"))
    )


def top_materials(materials: DataFrame, n: int = 10) -> DataFrame:
    """Best materials by revenue, in whole currency units."""
    summed = materials.groupBy("descripcion_material", "tipo_material").agg(
        total("revenue_total", 0).alias("revenue_total"), total("unidades_vendidas").alias("unidades_totales")
    )
    return top_k(summed, "revenue_total", n, "descripcion_material", "tipo_material")


def revenue_monthly(gold_orders: DataFrame) -> DataFrame:
    """Revenue per month and organisation without returns."""
    by_month = (
        gold_orders.where("not es_devolucion")
        .groupBy("anio_creacion", "mes_creacion", "org_ventas")
        .agg(total("valor_neto").alias("revenue_total"), F.count_distinct("numero_orden").alias("ordenes"))
    )
    return by_month.select(
        period_label("anio_creacion", "mes_creacion").alias("periodo"), "org_ventas", "revenue_total", "ordenes"
    )


def top_customers(gold_orders: DataFrame, n: int = 10) -> DataFrame:
    """Best customers by revenue without returns."""
    summed = (
        gold_orders.where("not es_devolucion")
        .groupBy("codigo_cliente")
        .agg(total("valor_neto").alias("revenue_total"), F.count_distinct("numero_orden").alias("total_ordenes"))
    )
    return top_k(summed, "revenue_total", n, "codigo_cliente")


def top_customers_in_year(gold_orders: DataFrame, year: int, n: int = 3) -> DataFrame:
    """Best customers by the revenue of one year."""
    in_year = gold_orders.where(
        F.col("fecha_creacion").between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date"))
    )
    return top_customers(in_year, n)


def last_year_equals(gold_customers: DataFrame, year: int, n: int = 3) -> DataFrame:
    """Best customers by all revenue among those whose last purchase was in a year."""
    columns = ("codigo_cliente", "nombre_cliente", "pais", "revenue_total", "total_ordenes", "clasificacion_abc")
    return top_k(
        gold_customers.where(F.col("ultimo_anio_compra") == year).select(*columns), "revenue_total", n, "codigo_cliente"
    )


def executive_kpis(gold_orders: DataFrame) -> DataFrame:
    """All revenue, orders, customers and returns; orders and customers are counted by bitmaps."""
    amount = money("valor_neto")
    by_order = distinct_bits(
        gold_orders,
        [],
        "numero_orden",
        F.sum(amount).alias("_sum"),
        F.count(amount).alias("_count"),
        F.count_if("es_devolucion").alias("_returns"),
    )
    customers = count_numbered(gold_orders, [], "codigo_cliente", "n").scalar()
    return by_order.agg(
        F.round(F.sum("_sum"), 2).cast("double").alias("revenue_total"),
        number_of_bits().alias("total_ordenes"),
        ratio(F.sum("_sum"), F.sum("_count")).alias("ticket_promedio"),
        F.coalesce(F.sum("_returns"), F.lit(0)).alias("devoluciones"),
    ).select(
        "revenue_total",
        "total_ordenes",
        F.coalesce(customers, F.lit(0)).alias("clientes_activos"),
        "ticket_promedio",
        "devoluciones",
    )


def revenue_by_channel(gold_orders: DataFrame) -> DataFrame:
    return (
        gold_orders.where("not es_devolucion")
        .groupBy("canal_distribucion")
        .agg(total("valor_neto").alias("revenue_total"), F.count_distinct("numero_orden").alias("ordenes"))
    )


def share_of_total(df: DataFrame, group: str, amount: str) -> DataFrame:
    """Sum per group and its share of the sum over all groups.

    The grand total is a scalar subquery over the same aggregation, so it stays distributed for any number of
    groups.
    """
    grouped = df.groupBy(group).agg(exact_sum(amount).alias("_sum"))
    everything = grouped.agg(F.sum("_sum")).scalar()
    return grouped.select(
        group, F.col("_sum").cast("double").alias("revenue"), percent(F.col("_sum"), everything).alias("pct_del_total")
    )


def returns_share(gold_orders: DataFrame) -> DataFrame:
    """Orders and revenue of returns and other orders, with their share of all revenue."""
    grouped = gold_orders.groupBy("es_devolucion").agg(
        F.count_distinct("numero_orden").alias("ordenes"), exact_sum("valor_neto").alias("_sum")
    )
    everything = grouped.agg(F.sum("_sum")).scalar()
    return grouped.select(
        "es_devolucion",
        "ordenes",
        F.round("_sum", 0).cast("double").alias("revenue"),
        percent(F.col("_sum"), everything).alias("pct_del_total"),
    )


def customers_by_country(gold_customers: DataFrame, active_only: bool = False) -> DataFrame:
    chosen = gold_customers.where("es_cliente_activo") if active_only else gold_customers
    return chosen.groupBy("pais").agg(
        F.count(F.lit(1)).alias("total_clientes"),
        F.count_if(F.col("clasificacion_abc") == ABC_LIMITS[0][1]).alias("clientes_a"),
        total("revenue_total", 0).alias("revenue_total"),
    )
