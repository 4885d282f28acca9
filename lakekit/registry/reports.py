"""Registered queries: joins, aggregations, reports and windows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from lakekit.functions.columns import pad_key

from lakekit.operators import cleaning
from lakekit.operators.changes import insert_new_only, latest_batch, update_where
from lakekit.operators.joins import broadcast_if_small, join_facts, join_lookup, join_master, join_validity, new_keys
from lakekit.operators.publish import access_audit
from lakekit.operators.ranking import latest_per_key
from lakekit.plans import finance, gold, silver, trends
from lakekit.plans import usage as usage_plans
from lakekit.registry import inputs
from lakekit.registry.sql import cents, money_mean, money_sum, month, pct, rdiv, sum_cents, year
from lakekit.sources import erp
from lakekit.streaming.chains import zone_kpis

AS_OF = date(2024, 1, 31)


def _valid_headers(spark, d):
    return silver.accounting_silver(erp.bkpf(spark, d))


def _price_periods(spark, d):
    joined = join_validity(
        inputs.usage(spark, d), inputs.prices(spark, d), "sku_name", "usage_start_time", "price_start_time",
        "price_end_time",
    )
    return joined.select("sku_name", "usage_start_time", "usage_quantity", F.col("pricing.default").alias("price"))


def _facts(spark, d):
    return erp.read_table(spark, d, "events").select(
        F.col("user_id").alias("zone"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.col("value").alias("amount"),
        F.length("event_type").cast("double").alias("distance"),
    )


def _access_log(spark, d):
    return erp.read_table(spark, d, "events").select(
        "event_id",
        F.col("ts").alias("event_time"),
        "event_type",
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email")).alias(
            "user_identity"
        ),
        F.struct(F.lit("sales").alias("share_name"), F.col("event_type").alias("table_name")).alias("request_params"),
        F.struct(F.lit(200).alias("status_code")).alias("response"),
    )


def _tiers_promoted(spark, d):
    return update_where(
        inputs.tiered_customers(spark, d), F.col("customer_tier") == "GOLD", {"customer_tier": F.lit("PLATINUM")}
    )


QUERIES = {
    # joins
    "join_header_lines": lambda s, d: erp.bkpf(s, d)
    .join(erp.bseg(s, d), list(finance.DOCUMENT_KEYS))
    .select(*finance.DOCUMENT_KEYS, "BUZEI", "BLART", "WAERK", "KONTO", "DMBTR"),
    "join_single_key": lambda s, d: erp.vbap(s, d)
    .join(erp.mara(s, d), "MATNR")
    .select("VBELN", "POSNR", "MATNR", "MATKL", "MTART", "NETWR"),
    "join_left_master": lambda s, d: join_master(
        gold.customer_metrics(erp.order_headers(s, d)),
        erp.kna1(s, d).select(F.col("KUNNR").alias("_k"), "NAME1", "LAND1"),
        "KUNNR",
        "_k",
    ).select("KUNNR", "total_ordenes", "revenue_total", "NAME1", "LAND1"),
    "join_left_on_conditions": lambda s, d: join_facts(
        inputs.silver_customers(s, d).select(
            "codigo_cliente", "nombre_cliente", pad_key("codigo_cliente").alias("KUNNR")
        ),
        erp.order_headers(s, d)
        .where((F.col("NETWR") > 400_000) & F.col("ERDAT").isNotNull())
        .select("KUNNR", "VBELN", "NETWR"),
        ["KUNNR"],
    ).drop("KUNNR"),
    "join_actual_budget": lambda s, d: inputs.monthly_kpis(s, d)
    .join(inputs.budget(s, d), list(finance.BUDGET_KEYS))
    .select(*finance.BUDGET_KEYS, "total_revenue", "budget_revenue"),
    "join_fx": lambda s, d: join_lookup(
        inputs.monthly_kpis(s, d), inputs.fx_rates(s, d), ["year", "month"], {"tasa_usd_cop": F.col("tasa_usd_cop")}
    ).select(*finance.BUDGET_KEYS, "total_revenue", "tasa_usd_cop"),
    "join_broadcast": lambda s, d: join_master(
        erp.order_headers(s, d).select("VBELN", "KUNNR", "NETWR"),
        broadcast_if_small(inputs.silver_customers(s, d).select("codigo_cliente", "nombre_cliente", "pais", "ciudad")),
        "KUNNR",
        "codigo_cliente",
    ).drop("codigo_cliente"),
    "join_price_validity": _price_periods,
    "anti_join_new_keys": lambda s, d: insert_new_only(
        erp.read_table(s, d, "labels"), erp.read_table(s, d, "documents").select("doc_id", "lang", "n_chars"), ["doc_id"]
    ),
    "anti_join_left_null": lambda s, d: new_keys(
        erp.bkpf(s, d), erp.bseg(s, d), finance.DOCUMENT_KEYS
    ).select(*finance.DOCUMENT_KEYS, "BLART"),
    "join_casted_key": lambda s, d: inputs.customer_360(s, d)
    .where(F.col("customer_tier").isin("PLATINUM", "GOLD"))
    .join(
        erp.read_table(s, d, "supplier").select(
            F.col("s_suppkey").cast("string").alias("_supplier"), F.col("s_name").alias("partner_name")
        ),
        F.col("customer_id").try_cast("bigint") == F.col("_supplier").try_cast("bigint"),
        "left",
    )
    .select("customer_id", "customer_name", "customer_tier", "total_revenue", "partner_name"),
    # aggregations and reports
    "sales_by_org_currency": lambda s, d: gold.sales_by_org_currency(erp.order_headers(s, d)),
    "doc_line_summary": lambda s, d: finance.doc_line_summary(erp.bkpf(s, d), erp.bseg(s, d)),
    "fin_summary": lambda s, d: finance.fin_summary(_valid_headers(s, d), erp.bseg(s, d)),
    "doc_metrics_top20": lambda s, d: finance.doc_metrics_top(
        erp.bkpf(s, d), erp.bseg(s, d), (2022, 2023, 2024), 20
    ),
    "doc_type_report": lambda s, d: finance.doc_type_report(s, erp.bkpf(s, d), erp.bseg(s, d), "1000", 2023, "COP"),
    "sales_kpis_monthly": inputs.monthly_kpis,
    "customer_metrics": lambda s, d: gold.customer_metrics(erp.order_headers(s, d)),
    "customer_abc": lambda s, d: cleaning.top_k(
        gold.customer_abc(erp.order_headers(s, d), erp.kna1(s, d)), "revenue_total", 20, "KUNNR"
    ),
    "customers_gold": inputs.gold_customers,
    "abc_distribution": lambda s, d: gold.abc_distribution(inputs.gold_customers(s, d)),
    "customer_360": inputs.customer_360,
    "tier_rollup": lambda s, d: gold.tier_rollup(inputs.tiered_customers(s, d)),
    "materials_gold": inputs.gold_materials,
    "top_materials": lambda s, d: gold.top_materials(inputs.gold_materials(s, d), 10),
    "revenue_monthly": lambda s, d: gold.revenue_monthly(inputs.gold_orders(s, d)),
    "top_customers": lambda s, d: gold.top_customers(inputs.gold_orders(s, d), 10),
    "top_customers_in_year": lambda s, d: gold.top_customers_in_year(inputs.gold_orders(s, d), 1998, 3),
    "last_year_equals": lambda s, d: gold.last_year_equals(inputs.gold_customers(s, d), 2000, 3),
    "executive_kpis": lambda s, d: gold.executive_kpis(inputs.gold_orders(s, d)),
    "revenue_by_channel": lambda s, d: gold.revenue_by_channel(inputs.gold_orders(s, d)),
    "returns_share": lambda s, d: gold.returns_share(inputs.gold_orders(s, d)),
    "customers_by_country": lambda s, d: gold.customers_by_country(inputs.gold_customers(s, d)),
    "active_customers_by_country": lambda s, d: gold.customers_by_country(inputs.gold_customers(s, d), True),
    "value_counts": lambda s, d: cleaning.value_counts(erp.order_headers(s, d), "KUNNR", "WAERK", digits=4),
    "distinct_profile": lambda s, d: cleaning.distinct_profile(
        erp.order_headers(s, d), "WAERK", "KUNNR", "VTWEG", numbered=("KUNNR",)
    ),
    "usage_by_tag": lambda s, d: usage_plans.usage_by_tag(inputs.usage(s, d), AS_OF),
    "usage_cost": lambda s, d: usage_plans.usage_cost(inputs.usage(s, d), inputs.prices(s, d), AS_OF),
    "usage_daily": lambda s, d: usage_plans.usage_daily(inputs.usage(s, d), "DSU", 15),
    "actual_vs_budget": lambda s, d: finance.actual_vs_budget(inputs.monthly_kpis(s, d), inputs.budget(s, d)),
    "revenue_normalised": lambda s, d: finance.revenue_normalised(inputs.monthly_kpis(s, d), inputs.fx_rates(s, d)),
    "zone_kpis": lambda s, d: zone_kpis(_facts(s, d)),
    "high_value_documents": lambda s, d: finance.high_value_documents(erp.bkpf(s, d), erp.bseg(s, d), 60_000),
    "tier_promotion_counts": lambda s, d: _tiers_promoted(s, d)
    .groupBy("customer_tier")
    .agg(F.count(F.lit(1)).alias("num_customers")),
    "grant_access_audit": lambda s, d: access_audit(
        _access_log(s, d),
        "view",
        datetime(2024, 1, 31),
        7,
        {
            "event_id": "event_id",
            "usuario": "user_identity.email",
            "conjunto": "request_params.share_name",
            "tabla": "request_params.table_name",
            "estado": "response.status_code",
        },
    ),
    # windows
    "monthly_trend": lambda s, d: trends.monthly_trend(erp.order_headers(s, d)),
    "pareto_top_n": lambda s, d: trends.material_pareto(erp.vbap(s, d), erp.mara(s, d), 5),
    "latest_per_key": lambda s, d: latest_per_key(
        erp.order_headers(s, d).select("KUNNR", "ERDAT", "VBELN", "NETWR", "AUART"), ["KUNNR"], "ERDAT"
    ),
    "share_of_total": lambda s, d: gold.share_of_total(inputs.gold_orders(s, d), "codigo_cliente", "valor_neto"),
    "moving_average": lambda s, d: trends.moving_average(erp.order_headers(s, d), 3),
    "rfm_segments": lambda s, d: trends.rfm_segments(erp.order_headers(s, d), date(2001, 12, 31)),
    "forecast_features": lambda s, d: trends.forecast_features(erp.order_headers(s, d)),
    # filters
    "filter_in_list": lambda s, d: erp.bkpf(s, d)
    .where(F.col("GJAHR").isin(2022, 2023, 2024))
    .select(*finance.DOCUMENT_KEYS, "BLART"),
    "filter_not_empty": lambda s, d: erp.read_table(s, d, "documents")
    .where(F.col("text").isNotNull() & (F.col("text") != ""))
    .select("doc_id", "lang", "n_chars"),
    "filter_like_prefix": lambda s, d: finance.account_prefix_totals(erp.bseg(s, d), "4"),
    "filter_params": lambda s, d: finance.doc_type_report(s, erp.bkpf(s, d), erp.bseg(s, d), "2000", 2021, "USD"),
    "filter_threshold": lambda s, d: erp.bkpf(s, d)
    .join(erp.bseg(s, d).where(F.col("DMBTR") > 60_000), list(finance.DOCUMENT_KEYS))
    .select(*finance.DOCUMENT_KEYS, "BUZEI", "KONTO", "WAERK", "DMBTR"),
    "filter_month_to_date": lambda s, d: usage_plans.month_to_date(inputs.usage(s, d), date(2024, 1, 15)).select(
        "usage_date", "usage_start_time", "sku_name", "usage_quantity"
    ),
    "filter_latest_batch": lambda s, d: latest_batch(
        erp.order_headers(s, d).select("VBELN", "ERDAT", "NETWR"), "ERDAT"
    ),
    # sort, limit, sets
    "top_k": lambda s, d: cleaning.top_k(
        inputs.customer_360(s, d).select("customer_id", "customer_name", "total_revenue"),
        "total_revenue",
        25,
        "customer_id",
    ),
    "dedup_by_key": lambda s, d: cleaning.dedup_by_key(erp.vbap(s, d), ["VBELN", "POSNR"]),
    "union_all": lambda s, d: erp.kna1(s, d)
    .select(F.lit("customer").alias("kind"), F.col("KUNNR").alias("partner"), "NAME1", "LAND1")
    .unionByName(erp.lfa1(s, d).select(F.lit("vendor").alias("kind"), F.col("LIFNR").alias("partner"), "NAME1", "LAND1")),
    "random_sample": lambda s, d: cleaning.random_sample(erp.order_headers(s, d), 50, "VBELN", 7),
}

DOC_TYPE = f"""
    SELECT BLART AS tipo_doc, count(DISTINCT h.BELNR) AS num_documentos, {money_sum('DMBTR')} AS monto_total,
        {money_mean('DMBTR')} AS monto_promedio
    FROM bkpf h JOIN bseg l ON h.BUKRS = l.BUKRS AND h.BELNR = l.BELNR AND h.GJAHR = l.GJAHR
    WHERE h.BUKRS = '{{}}' AND h.GJAHR = {{}} AND WAERK = '{{}}' GROUP BY BLART"""
LINE_JOIN = "FROM bkpf h JOIN bseg l ON h.BUKRS = l.BUKRS AND h.BELNR = l.BELNR AND h.GJAHR = l.GJAHR"
BUDGET = """budget AS (SELECT year, month, sales_org, currency,
    CAST((2 * CAST(round(total_revenue * 100) AS HUGEINT) *
        CASE month % 4 WHEN 0 THEN 95 WHEN 1 THEN 105 WHEN 2 THEN 120 ELSE 160 END + 100) // 200 AS DOUBLE) / 100
        AS budget_revenue,
    CAST(num_orders + 1 AS INTEGER) AS budget_orders,
    CASE month % 4 WHEN 3 THEN 'OPTIMISTA' ELSE 'BASE' END AS scenario FROM kpis)"""
FX = """fx AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST((year(o_orderdate) - 1995) * 100 + 3400 + month(o_orderdate) * 0.25 AS DOUBLE) AS tasa_usd_cop,
    CAST((year(o_orderdate) - 1995) * 100 + 3900 + month(o_orderdate) * 0.5 AS DOUBLE) AS tasa_eur_cop
    FROM orders WHERE month(o_orderdate) IN (1, 6, 12))"""
PRICES = """prices AS (
    SELECT DISTINCT event_type AS sku, TIMESTAMP '2023-01-01' AS f, TIMESTAMP '2024-01-16' AS t,
        1000 * length(event_type) AS price FROM events
    UNION ALL SELECT DISTINCT event_type, TIMESTAMP '2024-01-16', NULL, 1000 * length(event_type) + 500 FROM events)"""
IN_PERIOD = "JOIN prices ON sku_name = sku AND usage_start_time >= f AND (t IS NULL OR usage_start_time < t)"
CENTS_REVENUE = "CAST(round(total_revenue * 100) AS HUGEINT)"
CENTS_BUDGET = "CAST(round(budget_revenue * 100) AS HUGEINT)"
BUDGET_JOIN = "FROM kpis r JOIN budget b USING (year, month, sales_org, currency)"

ORACLES = {
    "random_sample": "SELECT * FROM vbak ORDER BY md5('7:' || VBELN), VBELN LIMIT 50",
    "join_header_lines": f"SELECT h.BUKRS, h.BELNR, h.GJAHR, BUZEI, BLART, WAERK, KONTO, DMBTR {LINE_JOIN}",
    "join_single_key": "SELECT VBELN, POSNR, p.MATNR, MATKL, MTART, NETWR FROM vbap p JOIN mara m ON p.MATNR = m.MATNR",
    "join_left_master": """SELECT m.KUNNR, total_ordenes, revenue_total, NAME1, LAND1
        FROM metrics m LEFT JOIN kna1 k ON m.KUNNR = k.KUNNR""",
    "join_left_on_conditions": """SELECT codigo_cliente, nombre_cliente, VBELN, NETWR
        FROM ksilver LEFT JOIN vbak ON codigo_cliente = KUNNR AND NETWR > 400000 AND ERDAT IS NOT NULL""",
    "join_actual_budget": f"""WITH {BUDGET} SELECT year, month, sales_org, currency, total_revenue, budget_revenue
        {BUDGET_JOIN}""",
    "join_fx": f"""WITH {FX} SELECT r.year, r.month, sales_org, currency, total_revenue, tasa_usd_cop
        FROM kpis r LEFT JOIN fx ON r.year = fx.year AND r.month = fx.month""",
    "join_broadcast": """SELECT VBELN, KUNNR, NETWR, nombre_cliente, pais, ciudad
        FROM vbak LEFT JOIN ksilver ON KUNNR = codigo_cliente""",
    "join_price_validity": f"""WITH {PRICES} SELECT sku_name, usage_start_time, usage_quantity,
        CAST(price AS DOUBLE) / 10000 AS price FROM usage {IN_PERIOD}""",
    "anti_join_new_keys": """SELECT doc_id, lang, n_chars FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "anti_join_left_null": """SELECT h.BUKRS, h.BELNR, h.GJAHR, BLART FROM bkpf h LEFT JOIN bseg l
        ON h.BUKRS = l.BUKRS AND h.BELNR = l.BELNR AND h.GJAHR = l.GJAHR WHERE l.BELNR IS NULL""",
    "join_casted_key": """SELECT customer_id, customer_name, customer_tier, total_revenue, s_name AS partner_name
        FROM c360 LEFT JOIN supplier ON CAST(customer_id AS BIGINT) = s_suppkey
        WHERE customer_tier IN ('PLATINUM', 'GOLD')""",
    "sales_by_org_currency": f"""SELECT VKORG, WAERK, {money_sum('NETWR')} AS TOTAL_VENTAS, count(VBELN) AS NUM_ORDENES
        FROM vbak GROUP BY VKORG, WAERK""",
    "doc_line_summary": f"""SELECT h.BUKRS, h.GJAHR, WAERK, count(DISTINCT h.BELNR) AS num_documents,
        count(BUZEI) AS num_lines, {money_sum('DMBTR')} AS total_amount, {money_mean('DMBTR')} AS avg_amount
        {LINE_JOIN} GROUP BY h.BUKRS, h.GJAHR, WAERK""",
    "fin_summary": f"""SELECT h.BUKRS AS company_code, h.GJAHR AS fiscal_year, WAERK AS currency,
        count(DISTINCT h.BELNR) AS num_documents, count(DISTINCT upper(trim(USNAM))) AS num_users,
        count(BUZEI) AS num_lines, {money_sum('DMBTR')} AS total_amount, {money_mean('DMBTR')} AS avg_amount
        {LINE_JOIN} GROUP BY h.BUKRS, h.GJAHR, WAERK""",
    "doc_metrics_top20": f"""SELECT h.BUKRS AS sociedad, h.GJAHR AS ejercicio, h.BELNR AS documento, WAERK AS moneda,
        USNAM AS usuario, count(BUZEI) AS num_lineas, {money_sum('DMBTR')} AS monto_total,
        {money_mean('DMBTR')} AS monto_promedio {LINE_JOIN} WHERE h.GJAHR IN (2022, 2023, 2024)
        GROUP BY ALL ORDER BY monto_total DESC, documento LIMIT 20""",
    "doc_type_report": DOC_TYPE.format("1000", 2023, "COP"),
    "sales_kpis_monthly": "SELECT * FROM kpis",
    "customer_metrics": "SELECT * FROM metrics",
    "customer_abc": "SELECT * FROM abc ORDER BY revenue_total DESC, KUNNR LIMIT 20",
    "customers_gold": "SELECT * FROM kgold",
    "abc_distribution": f"""SELECT clasificacion_abc, count(*) AS clientes,
        {money_mean('revenue_total', 0)} AS revenue_promedio FROM kgold GROUP BY clasificacion_abc""",
    "customer_360": "SELECT * FROM c360",
    "tier_rollup": f"""SELECT customer_tier, count(*) AS num_customers, {money_sum('total_revenue')} AS revenue
        FROM tiered GROUP BY customer_tier""",
    "materials_gold": "SELECT * FROM mgold",
    "top_materials": f"""SELECT descripcion_material, tipo_material,
        {rdiv(sum_cents('revenue_total'), '100', 0)} AS revenue_total,
        {money_sum('unidades_vendidas')} AS unidades_totales
        FROM mgold GROUP BY descripcion_material, tipo_material
        ORDER BY revenue_total DESC, descripcion_material, tipo_material LIMIT 10""",
    "revenue_monthly": f"""SELECT strftime(fecha_creacion, '%Y-%m') AS periodo, org_ventas,
        {money_sum('valor_neto')} AS revenue_total, count(DISTINCT numero_orden) AS ordenes
        FROM vgold WHERE NOT es_devolucion GROUP BY 1, 2""",
    "top_customers": f"""SELECT codigo_cliente, {money_sum('valor_neto')} AS revenue_total,
        count(DISTINCT numero_orden) AS total_ordenes FROM vgold WHERE NOT es_devolucion GROUP BY codigo_cliente
        ORDER BY revenue_total DESC, codigo_cliente LIMIT 10""",
    "top_customers_in_year": f"""SELECT codigo_cliente, {money_sum('valor_neto')} AS revenue_total,
        count(DISTINCT numero_orden) AS total_ordenes FROM vgold
        WHERE NOT es_devolucion AND anio_creacion = 1998 GROUP BY codigo_cliente
        ORDER BY revenue_total DESC, codigo_cliente LIMIT 3""",
    "last_year_equals": """SELECT codigo_cliente, nombre_cliente, pais, revenue_total, total_ordenes, clasificacion_abc
        FROM kgold WHERE ultimo_anio_compra = 2000 ORDER BY revenue_total DESC, codigo_cliente LIMIT 3""",
    "executive_kpis": f"""SELECT {money_sum('valor_neto')} AS revenue_total,
        count(DISTINCT numero_orden) AS total_ordenes, count(DISTINCT codigo_cliente) AS clientes_activos,
        {money_mean('valor_neto')} AS ticket_promedio, count(*) FILTER (WHERE es_devolucion) AS devoluciones
        FROM vgold""",
    "revenue_by_channel": f"""SELECT canal_distribucion, {money_sum('valor_neto')} AS revenue_total,
        count(DISTINCT numero_orden) AS ordenes FROM vgold WHERE NOT es_devolucion GROUP BY canal_distribucion""",
    "returns_share": f"""SELECT es_devolucion, ordenes, {rdiv('c', '100', 0)} AS revenue,
        {pct('c', 'total')} AS pct_del_total
        FROM (SELECT es_devolucion, count(DISTINCT numero_orden) AS ordenes, {sum_cents('valor_neto')} AS c,
              (SELECT {sum_cents('valor_neto')} FROM vgold) AS total FROM vgold GROUP BY es_devolucion)""",
    "customers_by_country": f"""SELECT pais, count(*) AS total_clientes,
        count(*) FILTER (WHERE clasificacion_abc = 'A - Strategic') AS clientes_a,
        {rdiv(sum_cents('revenue_total'), '100', 0)} AS revenue_total FROM kgold GROUP BY pais""",
    "active_customers_by_country": f"""SELECT pais, count(*) AS total_clientes,
        count(*) FILTER (WHERE clasificacion_abc = 'A - Strategic') AS clientes_a,
        {rdiv(sum_cents('revenue_total'), '100', 0)} AS revenue_total FROM kgold
        WHERE es_cliente_activo GROUP BY pais""",
    "value_counts": f"""SELECT KUNNR, WAERK, num_rows, {pct('num_rows', 'total', 4)} AS percent_of_total
        FROM (SELECT KUNNR, WAERK, count(*) AS num_rows, (SELECT count(*) FROM vbak) AS total
              FROM vbak GROUP BY KUNNR, WAERK)""",
    "distinct_profile": """SELECT count(*) AS total_rows, count(DISTINCT WAERK) AS distinct_WAERK,
        count(DISTINCT KUNNR) AS distinct_KUNNR, count(DISTINCT VTWEG) AS distinct_VTWEG FROM vbak""",
    "usage_by_tag": f"""SELECT coalesce(tag, 'sin-tag') AS proyecto, billing_origin_product AS producto, usage_unit,
        {money_sum('usage_quantity')} AS consumo FROM usage
        WHERE usage_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY ALL""",
    "usage_cost": f"""WITH {PRICES} SELECT billing_origin_product AS producto, sku_name,
        {money_sum('usage_quantity')} AS unidades,
        {rdiv(f"sum({cents('usage_quantity')} * price)", '1000000', 2)} AS costo_usd
        FROM usage {IN_PERIOD} WHERE usage_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY 1, 2""",
    "usage_daily": f"""SELECT usage_date, sku_name, {money_sum('usage_quantity')} AS dsus FROM usage
        WHERE usage_unit = 'DSU' GROUP BY usage_date, sku_name ORDER BY usage_date DESC, sku_name LIMIT 15""",
    "actual_vs_budget": f"""WITH {BUDGET} SELECT year, month, sales_org, currency, num_orders AS ordenes_reales,
        total_revenue AS ventas_reales, budget_orders AS ordenes_budget, budget_revenue AS ventas_budget,
        scenario AS escenario, CAST({CENTS_REVENUE} - {CENTS_BUDGET} AS DOUBLE) / 100 AS varianza,
        {pct(f'{CENTS_REVENUE} - {CENTS_BUDGET}', CENTS_BUDGET, 1)} AS varianza_pct,
        CASE WHEN {CENTS_REVENUE} >= {CENTS_BUDGET} THEN 'CUMPLE'
        WHEN 100 * {CENTS_REVENUE} >= 90 * {CENTS_BUDGET} THEN 'CERCA (>90%)'
        WHEN 100 * {CENTS_REVENUE} >= 75 * {CENTS_BUDGET} THEN 'GAP MODERADO' ELSE 'GAP CRITICO' END AS estado
        {BUDGET_JOIN}""",
    "revenue_normalised": f"""WITH {FX} SELECT r.year, r.month, sales_org, currency,
        total_revenue AS ventas_moneda_original,
        {rdiv(f'''(CASE currency WHEN 'COP' THEN {CENTS_REVENUE} * 100
            WHEN 'USD' THEN {CENTS_REVENUE} * CAST(round(tasa_usd_cop * 100) AS HUGEINT)
            WHEN 'EUR' THEN {CENTS_REVENUE} * CAST(round(tasa_eur_cop * 100) AS HUGEINT) END)''', '10000', 2)}
            AS ventas_cop, tasa_usd_cop, tasa_eur_cop
        FROM kpis r LEFT JOIN fx ON r.year = fx.year AND r.month = fx.month""",
    "zone_kpis": f"""SELECT user_id AS zone, {year('ts')} AS year, {month('ts')} AS month, count(*) AS num_facts,
        {money_sum('value')} AS revenue_total, {money_mean('value')} AS ticket_promedio,
        {money_mean('length(event_type)')} AS distancia_promedio FROM events GROUP BY 1, 2, 3""",
    "high_value_documents": f"""SELECT h.BUKRS, h.BELNR, h.GJAHR, BUZEI, BLART, WAERK, DMBTR AS monto,
        'Sociedad=' || h.BUKRS || ', Clase documento=' || coalesce(BLART, 'N/A') || ', Moneda=' || WAERK || ', Monto=' ||
        CAST(CAST(DMBTR AS DECIMAL(18,2)) AS VARCHAR) AS descripcion,
        CASE WHEN DMBTR > 120000 THEN 'Revisar: monto muy alto' WHEN WAERK <> 'COP' THEN 'Revisar: moneda extranjera'
        ELSE 'Sin anomalías detectadas.' END AS alerta_auditoria {LINE_JOIN} WHERE DMBTR > 60000""",
    "tier_promotion_counts": """SELECT CASE customer_tier WHEN 'GOLD' THEN 'PLATINUM' ELSE customer_tier END
        AS customer_tier, count(*) AS num_customers FROM tiered GROUP BY 1""",
    "grant_access_audit": """SELECT ts AS event_time, event_id,
        'user' || CAST(user_id AS VARCHAR) || '@example.com' AS usuario, 'sales' AS conjunto, event_type AS tabla,
        200 AS estado FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-24'""",
    "monthly_trend": f"""SELECT anio, mes, org_ventas, CAST(c AS DOUBLE) / 100 AS ventas_mes, num_ordenes,
        CAST(b AS DOUBLE) / 100 AS ventas_mes_anterior, {pct('c - b', 'b')} AS variacion_pct,
        CAST(y AS DOUBLE) / 100 AS ventas_ytd
        FROM (SELECT *, lag(c) OVER (PARTITION BY org_ventas ORDER BY anio, mes) AS b,
              sum(c) OVER (PARTITION BY org_ventas, anio ORDER BY mes ROWS UNBOUNDED PRECEDING) AS y FROM monthly)""",
    "pareto_top_n": f"""WITH sold AS (SELECT p.MATNR, MATKL AS categoria, MTART AS tipo_material,
            {sum_cents('NETWR')} AS c, {money_sum('KWMENG')} AS unidades_vendidas
            FROM vbap p JOIN mara m ON p.MATNR = m.MATNR GROUP BY 1, 2, 3),
        shared AS (SELECT *, rank() OVER (PARTITION BY categoria ORDER BY c DESC) AS r,
            sum(c) OVER (PARTITION BY categoria) AS t,
            sum(c) OVER (PARTITION BY categoria ORDER BY c DESC, MATNR ROWS UNBOUNDED PRECEDING) AS run FROM sold)
        SELECT categoria, MATNR, tipo_material, CAST(c AS DOUBLE) / 100 AS revenue_total, unidades_vendidas,
            CAST(r AS INTEGER) AS rank_categoria, {pct('c', 't')} AS pct_categoria,
            {pct('run', 't')} AS pct_acumulado_pareto FROM shared WHERE r <= 5""",
    "latest_per_key": """SELECT KUNNR, ERDAT, VBELN, NETWR, AUART FROM (SELECT *, row_number() OVER
        (PARTITION BY KUNNR ORDER BY ERDAT DESC, VBELN, NETWR, AUART) AS rn FROM vbak) WHERE rn = 1""",
    "share_of_total": f"""SELECT codigo_cliente, CAST(c AS DOUBLE) / 100 AS revenue, {pct('c', 't')} AS pct_del_total
        FROM (SELECT codigo_cliente, {sum_cents('valor_neto')} AS c,
              (SELECT {sum_cents('valor_neto')} FROM vgold) AS t FROM vgold GROUP BY codigo_cliente)""",
    "moving_average": f"""SELECT anio, mes, org_ventas, CAST(c AS DOUBLE) / 100 AS ventas_mes,
        {rdiv('s', '(100 * n)', 2)} AS media_movil
        FROM (SELECT *, sum(c) OVER w AS s, count(*) OVER w AS n FROM monthly
              WINDOW w AS (PARTITION BY org_ventas ORDER BY anio, mes ROWS 2 PRECEDING))""",
    "rfm_segments": f"""WITH base AS (SELECT KUNNR,
            CAST(datediff('day', max(ERDAT), DATE '2001-12-31') AS INTEGER) AS recency_days,
            count(DISTINCT VBELN) AS frequency, {sum_cents('NETWR')} AS c FROM vbak
            WHERE ERDAT IS NOT NULL GROUP BY KUNNR),
        scored AS (SELECT KUNNR, recency_days, frequency, CAST(c AS DOUBLE) / 100 AS monetary,
            CAST(ntile(5) OVER (ORDER BY recency_days DESC, KUNNR) AS INTEGER) AS r_score,
            CAST(ntile(5) OVER (ORDER BY frequency, KUNNR) AS INTEGER) AS f_score,
            CAST(ntile(5) OVER (ORDER BY c, KUNNR) AS INTEGER) AS m_score FROM base)
        SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
            WHEN r_score >= 4 AND f_score <= 2 THEN 'New' WHEN r_score <= 2 AND f_score >= 4 THEN 'At risk'
            WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost' ELSE 'Regular' END AS segment FROM scored""",
    "forecast_features": f"""WITH m AS (SELECT org_ventas, make_date(anio, mes, 1) AS month, c FROM monthly),
        cal AS (SELECT org_ventas, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE)
            AS month FROM m GROUP BY org_ventas),
        dense AS (SELECT cal.org_ventas, cal.month, coalesce(c, 0) AS c FROM cal
            LEFT JOIN m ON cal.org_ventas = m.org_ventas AND cal.month = m.month)
        SELECT org_ventas, month, CAST(row_number() OVER w - 1 AS INTEGER) AS month_index,
            CAST(c AS DOUBLE) / 100 AS sales, CAST(lag(c, 1) OVER w AS DOUBLE) / 100 AS lag_1,
            CAST(lag(c, 3) OVER w AS DOUBLE) / 100 AS lag_3, CAST(lag(c, 12) OVER w AS DOUBLE) / 100 AS lag_12,
            {rdiv('sum(c) OVER w3', '(100 * count(*) OVER w3)', 2)} AS rolling_mean_3,
            round(stddev_samp(CAST(c AS DOUBLE) / 100) OVER w3, 2) AS rolling_std_3
        FROM dense WINDOW w AS (PARTITION BY org_ventas ORDER BY month),
            w3 AS (PARTITION BY org_ventas ORDER BY month ROWS 2 PRECEDING)""",
    "filter_in_list": "SELECT BUKRS, BELNR, GJAHR, BLART FROM bkpf WHERE GJAHR IN (2022, 2023, 2024)",
    "filter_not_empty": "SELECT doc_id, lang, n_chars FROM documents WHERE text IS NOT NULL AND text <> ''",
    "filter_like_prefix": f"""SELECT count(*) AS num_lines, {money_sum('DMBTR')} AS total_amount
        FROM bseg WHERE KONTO LIKE '4%'""",
    "filter_params": DOC_TYPE.format("2000", 2021, "USD"),
    "filter_threshold": f"""SELECT h.BUKRS, h.BELNR, h.GJAHR, BUZEI, KONTO, WAERK, DMBTR {LINE_JOIN}
        WHERE DMBTR > 60000""",
    "filter_month_to_date": """SELECT usage_date, usage_start_time, sku_name, usage_quantity FROM usage
        WHERE usage_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-15'""",
    "filter_latest_batch": "SELECT VBELN, ERDAT, NETWR FROM vbak WHERE ERDAT = (SELECT max(ERDAT) FROM vbak)",
    "top_k": """SELECT customer_id, customer_name, total_revenue FROM c360
        ORDER BY total_revenue DESC NULLS LAST, customer_id LIMIT 25""",
    "dedup_by_key": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY VBELN, POSNR
        ORDER BY MATNR, KWMENG, NETWR, WAERK, MEINS, WERKS) AS rn FROM vbap) WHERE rn = 1""",
    "union_all": """SELECT 'customer' AS kind, KUNNR AS partner, NAME1, LAND1 FROM kna1
        UNION ALL SELECT 'vendor', LIFNR, NAME1, LAND1 FROM lfa1""",
}
