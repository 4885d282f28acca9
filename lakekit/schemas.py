"""Declared schemas. Keys and codes are strings: inferring them would drop leading zeros."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(text_columns: str, **typed: T.DataType) -> T.StructType:
    """Schema of string columns, with the named ones typed otherwise."""
    return T.StructType(
        [T.StructField(name, typed.get(name, T.StringType())) for name in text_columns.split()]
    )


ERP_SCHEMAS: dict[str, T.StructType] = {
    "BKPF": _schema("BUKRS BELNR GJAHR BLDAT BUDAT BLART WAERK USNAM XBLNR BKTXT"),
    "BSEG": _schema(
        "BUKRS BELNR GJAHR BUZEI KOART KONTO DMBTR WRBTR WAERS SGTXT",
        DMBTR=T.DoubleType(),
        WRBTR=T.DoubleType(),
    ),
    "KNA1": _schema("KUNNR NAME1 LAND1 ORT01 PSTLZ STRAS BRSCH KTOKD"),
    "MARA": _schema(
        "MATNR MTART MBRSH MATKL MEINS ERSDA LAEDA BRGEW NTGEW MAKTX",
        BRGEW=T.DoubleType(),
        NTGEW=T.DoubleType(),
    ),
    "VBAK": _schema("VBELN ERDAT KUNNR VKORG VTWEG SPART NETWR WAERK AUART", NETWR=T.DoubleType()),
    "VBAP": _schema(
        "VBELN POSNR MATNR KWMENG NETWR WAERK MEINS WERKS LGORT",
        KWMENG=T.DoubleType(),
        NETWR=T.DoubleType(),
    ),
    "LFA1": _schema("LIFNR NAME1 LAND1 ORT01 PSTLZ STRAS KTOKK BRSCH"),
    "EKKO": _schema("EBELN BUKRS BSTYP BSART LIFNR BEDAT NETWR WAERS EKORG EKGRP", NETWR=T.DoubleType()),
}

BUDGET_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType(), False),
        T.StructField("month", T.IntegerType(), False),
        T.StructField("sales_org", T.StringType(), False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("budget_revenue", T.DoubleType()),
        T.StructField("budget_orders", T.IntegerType()),
        T.StructField("budget_avg_order", T.DoubleType()),
        T.StructField("scenario", T.StringType()),
    ]
)

FX_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType(), False),
        T.StructField("month", T.IntegerType(), False),
        T.StructField("tasa_usd_cop", T.DoubleType()),
        T.StructField("tasa_eur_cop", T.DoubleType()),
        T.StructField("fuente", T.StringType()),
        T.StructField("tipo", T.StringType()),
    ]
)
