"""Codes, labels, limits and column names that results must carry exactly."""

from __future__ import annotations

# Order types that count as a return.
RETURN_TYPES = ("RE", "CR")

# Customer classes by total revenue, highest limit first; a class needs revenue strictly above its limit.
ABC_LIMITS = (
    (1_000_000, "A - Strategic"),
    (500_000, "B - Key Account"),
    (100_000, "C - Standard"),
)
ABC_LOWEST = "D - Small"

# Customer tiers by total revenue, highest limit first; strictly above.
TIER_LIMITS = (
    (500_000, "PLATINUM"),
    (100_000, "GOLD"),
    (50_000, "SILVER"),
)
TIER_LOWEST = "STANDARD"

# Budget attainment: revenue at or above this share (percent) of the budget, highest first.
BUDGET_STATUS = (
    (100, "CUMPLE"),
    (90, "CERCA (>90%)"),
    (75, "GAP MODERADO"),
)
BUDGET_STATUS_LOWEST = "GAP CRITICO"

# Tag shown for usage without a project tag.
NO_TAG = "sin-tag"

# Category for texts that match no category.
NO_CATEGORY = "Otro"

# Layout alarm: many files that are small.
SMALL_FILE_MB = 10
SMALL_FILE_COUNT = 50

# Quarantined rows tolerated before a run is stopped.
QUARANTINE_LIMIT = 100

# Amount above which a document line is reviewed.
HIGH_VALUE_AMOUNT = 100_000

# Change types of a change feed.
INSERT = "insert"
UPDATE_BEFORE = "update_preimage"
UPDATE_AFTER = "update_postimage"
DELETE = "delete"
CHANGE_TYPES_TO_SHIP = (INSERT, UPDATE_AFTER)

# Business names of the order columns in the gold layer.
ORDER_BUSINESS_NAMES = {
    "VBELN": "numero_orden",
    "ERDAT": "fecha_creacion",
    "KUNNR": "codigo_cliente",
    "VKORG": "org_ventas",
    "VTWEG": "canal_distribucion",
    "SPART": "division",
    "WAERK": "moneda",
    "AUART": "tipo_orden",
}

# Partition column of each ERP table in the bronze layer (None: unpartitioned).
BRONZE_PARTITIONS = {
    "BKPF": "GJAHR",
    "BSEG": "GJAHR",
    "KNA1": "LAND1",
    "MARA": "MTART",
    "VBAK": None,
    "VBAP": None,
    "LFA1": "LAND1",
    "EKKO": "BUKRS",
}

# Default categories of an accounting header text and the words that point to them.
DOCUMENT_CATEGORIES = {
    "Pago proveedor": ("vendor", "supplier", "proveedor", "pago"),
    "Factura cliente": ("customer", "invoice", "cliente", "factura"),
    "Asiento manual": ("manual", "journal", "asiento", "ajuste"),
    "Devolución": ("return", "refund", "devolución", "reintegro"),
    "Nómina": ("salary", "payroll", "nómina", "sueldo"),
    "Activo fijo": ("asset", "acquisition", "activo", "equipo"),
}

# Words that carry a positive or a negative judgement.
POSITIVE_WORDS = ("good", "great", "excellent", "fast", "bien", "bueno", "excelente", "rápido", "cumple")
NEGATIVE_WORDS = ("bad", "late", "broken", "poor", "mal", "malo", "tarde", "defecto", "pero")
