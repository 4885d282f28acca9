"""Registered queries: projection, cleaning and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.functions import columns as C
from lakekit.operators import cleaning
from lakekit.operators.learning import prepare_features
from lakekit.plans import silver
from lakekit.registry import inputs
from lakekit.registry.sql import month, rdiv, year
from lakekit.sources import erp


def _raw_dates(spark, d):
    """Order dates as text, the weekend ones broken."""
    day = F.col("o_orderdate").cast("date")
    return erp.read_table(spark, d, "orders").select(
        C.pad_key("o_orderkey").alias("VBELN"),
        F.when(F.weekday(day) >= 5, F.lit("00000000")).otherwise(F.date_format(day, "yyyyMMdd")).alias("ERDAT"),
    )


def _gappy_customers(spark, d):
    """Customers with empty names, missing countries and padded text."""
    return erp.kna1(spark, d).withColumns(
        {
            "NAME1": F.when(F.col("LAND1").endswith("7"), F.lit("  ")).otherwise(F.concat(F.lit(" "), "NAME1")),
            "LAND1": F.when(F.col("BRSCH") == "MACHINERY", F.lit(None)).otherwise(F.lower("LAND1")),
        }
    )


def _profile(spark, d):
    """Customer features with empty text, booleans and a column without any value."""
    customer = erp.read_table(spark, d, "customer")
    return customer.select(
        C.pad_key("c_custkey").alias("customer"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.col("c_mktsegment")).alias("segment"),
        (F.col("c_acctbal") > 0).alias("in_credit"),
        F.lit(None).cast("string").alias("unused"),
        F.when(F.col("c_nationkey") % 5 == 0, F.lit(None)).otherwise(F.col("c_nationkey").cast("string")).alias("area"),
        "c_acctbal",
    )


QUERIES = {
    "parse_yyyymmdd": lambda s, d: _raw_dates(s, d).withColumn("fecha", C.parse_yyyymmdd("ERDAT")),
    "pad_key": lambda s, d: erp.read_table(s, d, "customer").select(
        "c_custkey", C.pad_key("c_custkey").alias("KUNNR"), C.pad_key("c_nationkey", 3).alias("nation")
    ),
    "orders_silver": lambda s, d: silver.orders_silver(erp.vbak(s, d), inputs.CLOCK).drop("_loaded_at"),
    "orders_gold": inputs.gold_orders,
    "orders_checked": lambda s, d: silver.orders_checked(erp.order_headers(s, d)),
    "customers_silver": lambda s, d: silver.customers_silver(_gappy_customers(s, d)),
    "lines_silver": inputs.silver_lines,
    "accounting_silver": lambda s, d: silver.accounting_silver(erp.bkpf(s, d)),
    "validity_flag": lambda s, d: erp.read_table(s, d, "customer").select(
        "c_custkey",
        C.valid_unless(C.not_positive("c_acctbal"), C.is_blank("c_mktsegment")).alias("es_valido"),
    ),
    "validity_counts": lambda s, d: cleaning.validity_counts(
        silver.customers_silver(_gappy_customers(s, d)), "es_valido"
    ),
    "period_label": lambda s, d: erp.order_headers(s, d).select(
        "VBELN", C.period_label(F.year("ERDAT"), F.month("ERDAT")).alias("periodo")
    ),
    "date_parts": lambda s, d: erp.read_table(s, d, "events").select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month"), F.col("ts").cast("date").alias("day")
    ),
    "safe_ratio": lambda s, d: erp.read_table(s, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        C.safe_ratio(
            F.col("l_extendedprice").cast("decimal(18,2)"), (F.col("l_linenumber") % 3).cast("decimal(10,0)")
        ).cast("double").alias("price_ratio"),
    ),
    "active_flag": lambda s, d: erp.order_headers(s, d)
    .groupBy("KUNNR")
    .agg(F.max(F.year("ERDAT")).alias("last_year"))
    .withColumn("es_cliente_activo", C.active_since("last_year", 2003)),
    "mask_prefix": lambda s, d: erp.kna1(s, d).select(
        "KUNNR", C.mask_prefix("NAME1").alias("nombre_masked"), "LAND1", "ORT01"
    ),
    "null_to_default": lambda s, d: cleaning.null_to_default(
        erp.read_table(s, d, "documents")
        .select("doc_id", "lang")
        .join(erp.read_table(s, d, "labels"), "doc_id", "left"),
        {"quality": 0, "toxic": -1},
    ),
    "empty_to_null": lambda s, d: cleaning.empty_to_null(_profile(s, d)),
    "bool_to_int": lambda s, d: cleaning.bool_to_int(_profile(s, d).select("customer", "in_credit")),
    "drop_all_null_columns": lambda s, d: cleaning.drop_all_null_columns(_profile(s, d), keep=["customer"]),
    "fill_missing_category": lambda s, d: cleaning.fill_missing_category(
        _profile(s, d).select("customer", "segment", "area"), "customer"
    ),
    "add_constant_columns": lambda s, d: cleaning.add_constants(
        erp.bkpf(s, d).select("BUKRS", "BELNR", "GJAHR"), {"KOSTL": "CC001", "SEGMENT": "SEG01", "MANDT": "100"}
    ),
    "select_except": lambda s, d: cleaning.select_except(erp.order_headers(s, d), "SPART", "WAERK"),
    "compose_text": lambda s, d: erp.bkpf(s, d).select(
        "BELNR",
        C.labelled_text({"Sociedad": "BUKRS", "Clase documento": "BLART", "Moneda": "WAERK", "Año": "GJAHR"}).alias(
            "texto"
        ),
    ),
    "add_column_backfill": lambda s, d: cleaning.add_column_backfill(
        erp.read_table(s, d, "documents")
        .select("doc_id")
        .join(erp.read_table(s, d, "labels").select("doc_id", "quality"), "doc_id", "left"),
        "quality",
        F.lit(-1),
    ),
    "prepare_features": lambda s, d: prepare_features(
        _profile(s, d), ["customer", "segment", "in_credit", "unused", "area", "c_acctbal"], "customer"
    ),
}

PROFILE = """profile AS (SELECT repeat('0', greatest(10 - length(CAST(c_custkey AS VARCHAR)), 0)) || CAST(c_custkey AS VARCHAR) AS customer,
    CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS segment, c_acctbal > 0 AS in_credit,
    CAST(NULL AS VARCHAR) AS unused,
    CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS area, c_acctbal FROM customer)"""
GAPPY = """gappy AS (SELECT KUNNR, CASE WHEN LAND1 LIKE '%7' THEN '  ' ELSE ' ' || NAME1 END AS NAME1,
    CASE WHEN BRSCH = 'MACHINERY' THEN NULL ELSE lower(LAND1) END AS LAND1, ORT01, BRSCH, KTOKD FROM kna1)"""
VALID = "NOT (NAME1 IS NULL OR trim(NAME1) = '' OR LAND1 IS NULL OR trim(LAND1) = '')"

ORACLES = {
    "parse_yyyymmdd": """WITH raw AS (SELECT VBELN, CASE WHEN isodow(ERDAT) >= 6 THEN '00000000'
            ELSE strftime(ERDAT, '%Y%m%d') END AS ERDAT FROM vbak)
        SELECT VBELN, ERDAT, CAST(try_strptime(ERDAT, '%Y%m%d') AS DATE) AS fecha FROM raw""",
    "pad_key": """SELECT c_custkey, repeat('0', greatest(10 - length(CAST(c_custkey AS VARCHAR)), 0)) || CAST(c_custkey AS VARCHAR) AS KUNNR,
        repeat('0', greatest(3 - length(CAST(c_nationkey AS VARCHAR)), 0)) || CAST(c_nationkey AS VARCHAR) AS nation FROM customer""",
    "orders_silver": "SELECT * FROM vbak",
    "orders_gold": "SELECT * FROM vgold",
    "orders_checked": f"""SELECT VBELN, ERDAT, KUNNR, VKORG, VTWEG, SPART, NETWR, WAERK, upper(trim(AUART)) AS AUART,
        {year('ERDAT')} AS YEAR, {month('ERDAT')} AS MONTH, coalesce(NETWR > 0, FALSE) AND KUNNR IS NOT NULL AS _is_valid FROM vbak""",
    "customers_silver": f"""WITH {GAPPY} SELECT KUNNR AS codigo_cliente, trim(NAME1) AS nombre_cliente,
        upper(trim(LAND1)) AS pais, trim(ORT01) AS ciudad, trim(BRSCH) AS sector_industria,
        trim(KTOKD) AS grupo_cuentas, {VALID} AS es_valido FROM gappy""",
    "lines_silver": "SELECT * FROM lsilver",
    "accounting_silver": """SELECT BUKRS, BELNR, GJAHR, BLDAT, BUDAT, BLART, WAERK, upper(trim(USNAM)) AS USNAM,
        trim(BKTXT) AS BKTXT, CAST(strptime(BLDAT, '%Y%m%d') AS DATE) AS BLDAT_DT,
        CAST(strptime(BUDAT, '%Y%m%d') AS DATE) AS BUDAT_DT, TRUE AS _is_valid FROM bkpf""",
    "validity_flag": """SELECT c_custkey, coalesce(c_acctbal > 0 AND trim(c_mktsegment) <> '', FALSE) AS es_valido FROM customer""",
    "validity_counts": f"""WITH {GAPPY} SELECT count(*) AS total_rows, count(*) FILTER (WHERE {VALID}) AS valid_rows,
        count(*) FILTER (WHERE NOT ({VALID})) AS invalid_rows,
        100 * count(*) FILTER (WHERE {VALID}) // count(*) AS valid_percent FROM gappy""",
    "period_label": "SELECT VBELN, strftime(ERDAT, '%Y-%m') AS periodo FROM vbak",
    "date_parts": f"""SELECT event_id, {year('ts')} AS year, {month('ts')} AS month, CAST(ts AS DATE) AS day
        FROM events""",
    "safe_ratio": f"""SELECT l_orderkey, l_linenumber, l_partkey,
        {rdiv('round(l_extendedprice * 100)', '100 * (l_linenumber % 3)', 2)} AS price_ratio FROM lineitem""",
    "active_flag": f"""SELECT KUNNR, max({year('ERDAT')}) AS last_year, max(year(ERDAT)) >= 2001 AS es_cliente_activo
        FROM vbak GROUP BY KUNNR""",
    "mask_prefix": "SELECT KUNNR, substr(NAME1, 1, 3) || '***' AS nombre_masked, LAND1, ORT01 FROM kna1",
    "null_to_default": """SELECT d.doc_id, lang, coalesce(quality, 0) AS quality, coalesce(toxic, -1) AS toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "empty_to_null": f"WITH {PROFILE} SELECT * REPLACE (nullif(segment, '') AS segment) FROM profile",
    "bool_to_int": f"WITH {PROFILE} SELECT customer, CAST(in_credit AS INTEGER) AS in_credit FROM profile",
    "drop_all_null_columns": f"WITH {PROFILE} SELECT * EXCLUDE (unused) FROM profile",
    "fill_missing_category": f"""WITH {PROFILE} SELECT customer, coalesce(segment, 'Nosegment') AS segment,
        coalesce(area, 'Noarea') AS area FROM profile""",
    "add_constant_columns": """SELECT BUKRS, BELNR, GJAHR, 'CC001' AS KOSTL, 'SEG01' AS SEGMENT, '100' AS MANDT
        FROM bkpf""",
    "select_except": "SELECT * EXCLUDE (SPART, WAERK) FROM vbak",
    "compose_text": """SELECT BELNR, 'Sociedad=' || BUKRS || ', Clase documento=' || coalesce(BLART, 'N/A') || ', Moneda=' || WAERK ||
        ', Año=' || CAST(GJAHR AS VARCHAR) AS texto FROM bkpf""",
    "add_column_backfill": """SELECT d.doc_id, coalesce(quality, -1) AS quality
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "prepare_features": f"""WITH {PROFILE} SELECT customer, coalesce(nullif(segment, ''), 'Nosegment') AS segment,
        CAST(in_credit AS INTEGER) AS in_credit, coalesce(area, 'Noarea') AS area, c_acctbal FROM profile""",
}
