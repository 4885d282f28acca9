"""Silver layer: typed, cleaned and flagged tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.columns import (
    clean_code,
    clean_text,
    is_blank,
    moment,
    not_positive,
    pad_key,
    parse_yyyymmdd,
    valid_unless,
)
from lakekit.functions.money import MONEY, QUANTITY
from lakekit.operators.cleaning import dedup_by_key
from lakekit.operators.joins import join_master


def _loaded(loaded_at: datetime | None):
    return moment(loaded_at) if loaded_at else F.localtimestamp()


def orders_silver(bronze: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Orders with dates, padded keys and codes as text."""
    return bronze.withColumns(
        {
            "ERDAT": parse_yyyymmdd("ERDAT"),
            "VBELN": pad_key("VBELN"),
            "KUNNR": pad_key("KUNNR"),
            "VKORG": F.col("VKORG").cast("string"),
            "VTWEG": F.col("VTWEG").cast("string"),
            "SPART": F.col("SPART").cast("string"),
            "NETWR": F.col("NETWR").cast("double"),
            "_loaded_at": _loaded(loaded_at),
        }
    )


def orders_checked(orders: DataFrame) -> DataFrame:
    """Orders with year, month, tidy type and a validity flag; one row per order.

    An amount that is missing counts as invalid.
    """
    flagged = orders.withColumns(
        {
            "YEAR": F.year("ERDAT"),
            "MONTH": F.month("ERDAT"),
            "AUART": clean_code("AUART"),
            "_is_valid": valid_unless(not_positive("NETWR"), F.col("KUNNR").isNull()),
        }
    )
    return dedup_by_key(flagged, ["VBELN"])


def customers_silver(bronze: DataFrame) -> DataFrame:
    """Customers under business names, trimmed, with a validity flag; rows without a key are dropped."""
    return bronze.where(F.col("KUNNR").isNotNull()).select(
        F.col("KUNNR").alias("codigo_cliente"),
        clean_text("NAME1").alias("nombre_cliente"),
        clean_code("LAND1").alias("pais"),
        clean_text("ORT01").alias("ciudad"),
        clean_text("BRSCH").alias("sector_industria"),
        clean_text("KTOKD").alias("grupo_cuentas"),
        valid_unless(is_blank("NAME1"), is_blank("LAND1")).alias("es_valido"),
    )


def lines_silver(lines: DataFrame, materials: DataFrame) -> DataFrame:
    """Order lines with the description of their material and a validity flag; unknown materials stay."""
    keyed = lines.where(F.col("VBELN").isNotNull() & F.col("MATNR").isNotNull())
    master = materials.select(F.col("MATNR").alias("_material"), "MAKTX", "MTART", "MATKL")
    return join_master(keyed, master, "MATNR", "_material").select(
        F.col("VBELN").alias("numero_orden"),
        F.col("POSNR").alias("posicion"),
        F.col("MATNR").alias("codigo_material"),
        clean_text("MAKTX").alias("descripcion_material"),
        F.col("MTART").alias("tipo_material"),
        F.col("MATKL").alias("categoria_material"),
        F.col("KWMENG").cast(QUANTITY).cast("double").alias("cantidad"),
        F.col("NETWR").cast(MONEY).cast("double").alias("valor_neto"),
        F.col("WAERK").alias("moneda"),
        valid_unless(not_positive("NETWR"), not_positive("KWMENG")).alias("es_valido"),
    )


def accounting_silver(bronze: DataFrame) -> DataFrame:
    """Accounting headers with dates, tidy texts and a validity flag over the key; one row per key."""
    cleaned = bronze.withColumns(
        {
            "BLDAT_DT": parse_yyyymmdd("BLDAT"),
            "BUDAT_DT": parse_yyyymmdd("BUDAT"),
            "USNAM": clean_code("USNAM"),
            "BKTXT": clean_text("BKTXT"),
            "_is_valid": valid_unless(
                F.col("BELNR").isNull(), F.col("BUKRS").isNull(), F.col("GJAHR").isNull()
            ),
        }
    )
    return dedup_by_key(cleaned.drop("_source_file", "_batch_id"), ["BUKRS", "BELNR", "GJAHR"])
