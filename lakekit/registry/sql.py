"""Building blocks of the check SQL (ANSI, run by DuckDB on the same tables)."""

from __future__ import annotations

import re


def cents(x: str) -> str:
    return f"CAST(round(({x}) * 100) AS HUGEINT)"


def sum_cents(x: str) -> str:
    return f"sum({cents(x)})"


def money_sum(x: str) -> str:
    """Exact sum of amounts, as a double."""
    return f"(CAST({sum_cents(x)} AS DOUBLE) / 100)"


def rdiv(numerator: str, denominator: str, digits: int) -> str:
    """Integer ratio rounded half away from zero; NULL for a zero denominator."""
    scale = 10**digits
    n, d = f"CAST({numerator} AS HUGEINT)", f"NULLIF(CAST({denominator} AS HUGEINT), 0)"
    quotient = f"((2 * abs({n}) * {scale} + abs({d})) // (2 * abs({d})))"
    return f"(CAST((CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) * {quotient} AS DOUBLE) / {scale})"


def money_mean(x: str, digits: int = 2) -> str:
    return rdiv(sum_cents(x), f"(100 * count({x}))", digits)


def pct(part: str, whole: str, digits: int = 2) -> str:
    return rdiv(f"(100 * ({part}))", whole, digits)


def key(x: str, width: int = 10) -> str:
    """A key as text, zeros before it up to a width: the number of zeros is never negative."""
    return f"(repeat('0', greatest({width} - length(CAST({x} AS VARCHAR)), 0)::BIGINT) || CAST({x} AS VARCHAR))"


def currency(x: str) -> str:
    return f"CASE {x} % 3 WHEN 0 THEN 'COP' WHEN 1 THEN 'USD' ELSE 'EUR' END"


def year(x: str) -> str:
    return f"CAST(year({x}) AS INTEGER)"


def month(x: str) -> str:
    return f"CAST(month({x}) AS INTEGER)"


VIEWS = {
    "vbak": f"""SELECT {key('o_orderkey')} AS VBELN, CAST(o_orderdate AS DATE) AS ERDAT, {key('o_custkey')} AS KUNNR,
        CAST(1000 * (o_custkey % 3 + 1) AS VARCHAR) AS VKORG, o_orderstatus AS VTWEG,
        {key('o_orderkey % 5 + 1', 2)} AS SPART, o_totalprice AS NETWR, {currency('o_orderkey')} AS WAERK,
        o_orderpriority AS AUART FROM orders""",
    "vbap": f"""SELECT {key('l_orderkey')} AS VBELN, {key('l_linenumber', 6)} AS POSNR, {key('l_partkey')} AS MATNR,
        l_quantity AS KWMENG, l_extendedprice AS NETWR, {currency('l_orderkey')} AS WAERK,
        l_returnflag AS MEINS, l_linestatus AS WERKS FROM lineitem""",
    "bkpf": f"""SELECT CAST(1000 * (o_orderkey % 7 % 3 + 1) AS VARCHAR) AS BUKRS, {key('o_orderkey')} AS BELNR,
        CAST(2020 + o_orderkey % 5 AS INTEGER) AS GJAHR, strftime(o_orderdate, '%Y%m%d') AS BLDAT,
        strftime(o_orderdate, '%Y%m%d') AS BUDAT, substr(o_orderpriority, 1, 1) AS BLART,
        {currency('o_orderkey')} AS WAERK, ' user' || CAST(o_custkey % 50 AS VARCHAR) || ' ' AS USNAM,
        o_orderpriority AS BKTXT FROM orders""",
    "bseg": f"""SELECT CAST(1000 * (l_orderkey % 7 % 3 + 1) AS VARCHAR) AS BUKRS, {key('l_orderkey')} AS BELNR,
        CAST(2020 + l_orderkey % 5 AS INTEGER) AS GJAHR, {key('l_linenumber', 3)} AS BUZEI,
        CAST(l_partkey AS VARCHAR) AS KONTO, l_extendedprice AS DMBTR FROM lineitem""",
    "kna1": f"""SELECT {key('c_custkey')} AS KUNNR, c_name AS NAME1, n_name AS LAND1,
        'City ' || CAST(n_regionkey AS VARCHAR) AS ORT01, c_mktsegment AS BRSCH, 'KUNA' AS KTOKD
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "mara": f"""SELECT {key('p_partkey')} AS MATNR, p_type AS MTART, p_brand AS MATKL, p_name AS MAKTX FROM part""",
    "lfa1": f"""SELECT {key('s_suppkey')} AS LIFNR, s_name AS NAME1, n_name AS LAND1
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "ekko": f"""SELECT {key('l_orderkey')} AS EBELN, l_linestatus AS BUKRS, {key('l_suppkey')} AS LIFNR,
        l_extendedprice AS NETWR, {currency('l_orderkey')} AS WAERS FROM lineitem""",
    "vgold": f"""SELECT VBELN AS numero_orden, ERDAT AS fecha_creacion, KUNNR AS codigo_cliente, VKORG AS org_ventas,
        VTWEG AS canal_distribucion, SPART AS division, WAERK AS moneda, AUART AS tipo_orden, NETWR AS valor_neto,
        {year('ERDAT')} AS anio_creacion, {month('ERDAT')} AS mes_creacion,
        coalesce(AUART IN ('4-NOT SPECIFIED', '5-LOW'), FALSE) AS es_devolucion FROM vbak""",
    "ksilver": """SELECT KUNNR AS codigo_cliente, trim(NAME1) AS nombre_cliente, upper(trim(LAND1)) AS pais,
        trim(ORT01) AS ciudad, trim(BRSCH) AS sector_industria, trim(KTOKD) AS grupo_cuentas,
        NOT (NAME1 IS NULL OR trim(NAME1) = '' OR LAND1 IS NULL OR trim(LAND1) = '') AS es_valido
        FROM kna1 WHERE KUNNR IS NOT NULL""",
    "lsilver": """SELECT VBELN AS numero_orden, POSNR AS posicion, p.MATNR AS codigo_material,
        trim(MAKTX) AS descripcion_material, MTART AS tipo_material, MATKL AS categoria_material,
        KWMENG AS cantidad, NETWR AS valor_neto, WAERK AS moneda,
        NETWR IS NOT NULL AND NETWR > 0 AND KWMENG IS NOT NULL AND KWMENG > 0 AS es_valido
        FROM vbap p LEFT JOIN mara m ON p.MATNR = m.MATNR WHERE VBELN IS NOT NULL AND p.MATNR IS NOT NULL""",
    "metrics": f"""SELECT KUNNR, count(DISTINCT VBELN) AS total_ordenes, {money_sum('NETWR')} AS revenue_total,
        {money_mean('NETWR')} AS ticket_promedio, min({year('ERDAT')}) AS primer_anio,
        max({year('ERDAT')}) AS ultimo_anio FROM vbak WHERE ERDAT IS NOT NULL GROUP BY KUNNR""",
    "abc": """SELECT m.*, NAME1 AS nombre_cliente, LAND1 AS pais, ORT01 AS ciudad,
        CASE WHEN revenue_total > 1000000 THEN 'A - Strategic' WHEN revenue_total > 500000 THEN 'B - Key Account'
        WHEN revenue_total > 100000 THEN 'C - Standard' ELSE 'D - Small' END AS clasificacion_abc
        FROM metrics m LEFT JOIN kna1 k ON m.KUNNR = k.KUNNR""",
    "kmetrics": f"""SELECT KUNNR, count(DISTINCT VBELN) AS total_ordenes, {money_sum('NETWR')} AS revenue_total,
        {money_mean('NETWR')} AS ticket_promedio,
        count(*) FILTER (WHERE AUART IN ('4-NOT SPECIFIED', '5-LOW')) AS total_devoluciones,
        count(DISTINCT year(ERDAT)) AS anios_activo, min({year('ERDAT')}) AS primer_anio_compra,
        max({year('ERDAT')}) AS ultimo_anio_compra, count(DISTINCT VKORG) AS orgs_ventas_activas
        FROM vbak GROUP BY KUNNR""",
    "kgold": """SELECT codigo_cliente, nombre_cliente, pais, ciudad, sector_industria, es_valido,
        coalesce(total_ordenes, 0) AS total_ordenes, coalesce(revenue_total, 0) AS revenue_total,
        coalesce(ticket_promedio, 0) AS ticket_promedio, coalesce(total_devoluciones, 0) AS total_devoluciones,
        coalesce(anios_activo, 0) AS anios_activo, primer_anio_compra, ultimo_anio_compra,
        coalesce(orgs_ventas_activas, 0) AS orgs_ventas_activas,
        CASE WHEN coalesce(revenue_total, 0) > 3000000 THEN 'A - Strategic'
        WHEN coalesce(revenue_total, 0) > 2000000 THEN 'B - Key Account'
        WHEN coalesce(revenue_total, 0) > 1000000 THEN 'C - Standard' ELSE 'D - Small' END AS clasificacion_abc,
        coalesce(ultimo_anio_compra >= 2001, FALSE) AS es_cliente_activo
        FROM ksilver LEFT JOIN kmetrics ON codigo_cliente = KUNNR WHERE es_valido""",
    "c360": f"""SELECT codigo_cliente AS customer_id, nombre_cliente AS customer_name, pais AS country,
        ciudad AS city, sector_industria AS industry_sector, count(DISTINCT VBELN) AS total_orders,
        {money_sum('NETWR')} AS total_revenue, {money_mean('NETWR')} AS avg_order_value,
        min(ERDAT) AS first_order_date, max(ERDAT) AS last_order_date,
        CAST(datediff('day', min(ERDAT), max(ERDAT)) AS INTEGER) AS customer_lifetime_days,
        CASE WHEN sum(NETWR) > 500000 THEN 'PLATINUM' WHEN sum(NETWR) > 100000 THEN 'GOLD'
        WHEN sum(NETWR) > 50000 THEN 'SILVER' ELSE 'STANDARD' END AS customer_tier
        FROM ksilver LEFT JOIN vbak ON codigo_cliente = KUNNR AND NETWR > 0 AND ERDAT IS NOT NULL
        WHERE es_valido GROUP BY ALL""",
    "tiered": """SELECT customer_id, total_revenue, CASE WHEN total_revenue > 3000000 THEN 'PLATINUM'
        WHEN total_revenue > 2000000 THEN 'GOLD' WHEN total_revenue > 1000000 THEN 'SILVER' ELSE 'STANDARD' END
        AS customer_tier FROM c360""",
    "mgold": f"""SELECT codigo_material, descripcion_material, tipo_material, categoria_material,
        {year('ERDAT')} AS anio, {month('ERDAT')} AS mes, VKORG AS org_ventas, KUNNR AS codigo_cliente,
        count(DISTINCT numero_orden) AS total_ordenes, {money_sum('cantidad')} AS unidades_vendidas,
        {money_sum('valor_neto')} AS revenue_total, strftime(min(ERDAT), '%Y-%m') AS periodo
        FROM lsilver JOIN vbak ON numero_orden = VBELN WHERE es_valido AND ERDAT IS NOT NULL
        GROUP BY codigo_material, descripcion_material, tipo_material, categoria_material, year(ERDAT), month(ERDAT),
        VKORG, KUNNR""",
    "kpis": f"""SELECT {year('ERDAT')} AS year, {month('ERDAT')} AS month, VKORG AS sales_org, WAERK AS currency,
        count(DISTINCT VBELN) AS num_orders, count(DISTINCT KUNNR) AS num_customers,
        {money_sum('NETWR')} AS total_revenue, {money_mean('NETWR')} AS avg_order_value,
        max(NETWR) AS max_order_value, min(NETWR) AS min_order_value
        FROM vbak WHERE NETWR > 0 AND ERDAT IS NOT NULL GROUP BY ALL""",
    "monthly": f"""SELECT VKORG AS org_ventas, {year('ERDAT')} AS anio, {month('ERDAT')} AS mes,
        {sum_cents('NETWR')} AS c, count(DISTINCT VBELN) AS num_ordenes FROM vbak
        WHERE ERDAT IS NOT NULL GROUP BY ALL""",
    "usage": """SELECT CAST(ts AS DATE) AS usage_date, ts AS usage_start_time, event_type AS sku_name,
        'product-' || event_type AS billing_origin_product,
        CASE WHEN event_type IN ('error', 'signup') THEN 'DSU' ELSE 'DBU' END AS usage_unit, value AS usage_quantity,
        CASE WHEN TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) < 50
             THEN 'p' || CAST(TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 10 AS VARCHAR) END AS tag
        FROM events""",
    "hist0": "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
    "hist1": """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'XXX' ELSE c_mktsegment END AS c_mktsegment,
        c_acctbal FROM hist0""",
    "hist2": """SELECT c_custkey, c_mktsegment, c_acctbal FROM hist1 WHERE c_acctbal >= 0
        UNION ALL SELECT -1 - s_suppkey, 'SUPPLIER', s_acctbal FROM supplier""",
}


def step_feed(before: str, after: str, version: int, at: str) -> str:
    """Change feed between two customer states, version by version."""
    stamp = f"CAST({version} AS BIGINT) AS _commit_version, TIMESTAMP '{at}' AS _commit_timestamp"
    changed = "(b.c_mktsegment IS DISTINCT FROM a.c_mktsegment OR b.c_acctbal IS DISTINCT FROM a.c_acctbal)"
    return f"""
        SELECT a.c_custkey, a.c_mktsegment, a.c_acctbal, 'insert' AS _change_type, {stamp}
        FROM {after} a WHERE a.c_custkey NOT IN (SELECT c_custkey FROM {before})
        UNION ALL SELECT b.c_custkey, b.c_mktsegment, b.c_acctbal, 'delete', {stamp}
        FROM {before} b WHERE b.c_custkey NOT IN (SELECT c_custkey FROM {after})
        UNION ALL SELECT b.c_custkey, b.c_mktsegment, b.c_acctbal, 'update_preimage', {stamp}
        FROM {before} b JOIN {after} a ON a.c_custkey = b.c_custkey AND {changed}
        UNION ALL SELECT a.c_custkey, a.c_mktsegment, a.c_acctbal, 'update_postimage', {stamp}
        FROM {before} b JOIN {after} a ON a.c_custkey = b.c_custkey AND {changed}"""


VIEWS["feed"] = (
    step_feed("hist0", "hist1", 1, "2024-02-01 00:00:00")
    + " UNION ALL "
    + step_feed("hist1", "hist2", 2, "2024-03-01 00:00:00")
)


def with_views(query: str) -> str:
    """Put the definitions of the named views that a query uses, directly or not, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(query)
    if not needed:
        return query
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    joined = query.strip()
    return f"WITH {ctes}, {joined[5:]}" if joined.upper().startswith("WITH ") else f"WITH {ctes}\n{joined}"
