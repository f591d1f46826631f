"""Small reference dimensions. All of them are fixed in size, not grown from data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values -------------------------------------------------------------------------
LABELS = {
    "beras": "Beras",
    "jagung": "Jagung",
    "kedelai": "Kedelai",
    "gula": "Gula",
    "minyak_goreng": "Minyak Goreng",
    "cabai": "Cabai",
    "bawang_merah": "Bawang Merah",
    "telur": "Telur",
}
REFERENCE_PRICES = {
    "beras": 14500,
    "jagung": 5800,
    "kedelai": 12000,
    "gula": 17000,
    "minyak_goreng": 17500,
    "cabai": 45000,
    "bawang_merah": 38000,
    "telur": 29000,
}
UNITS = {"minyak_goreng": "liter"}
DEFAULT_UNIT = "kg"
SYNONYMS = {
    "beras medium": "beras",
    "beras premium": "beras",
    "minyak goreng": "minyak_goreng",
    "minyak goreng curah": "minyak_goreng",
    "bawang merah": "bawang_merah",
    "cabe merah": "cabai",
    "cabe rawit": "cabai",
    "cabai merah": "cabai",
}
NEWS_KEYWORDS = {
    "beras": ["beras", "padi", "gabah"],
    "jagung": ["jagung"],
    "kedelai": ["kedelai", "tempe", "tahu"],
    "gula": ["gula", "tebu"],
    "minyak_goreng": ["minyak goreng", "minyak sawit", "CPO"],
    "cabai": ["cabai", "cabe"],
    "bawang_merah": ["bawang merah", "bawang"],
    "telur": ["telur ayam", "telur"],
}
TITLE_KEYWORDS = {
    "beras": "beras",
    "jagung": "jagung",
    "kedelai": "kedelai",
    "gula": "gula",
    "minyak_goreng": "minyak",
    "cabai": "cabai",
    "bawang_merah": "bawang",
    "telur": "telur",
}
GENERAL = "umum"
MARKUP = {"jagung": 1.8, "kedelai": 1.5, "gula": 2.2}
DEFAULT_MARKUP = 1.5
USD_RATE = 15800

PRICE_MIN, PRICE_MAX = 100.0, 1_000_000.0
CV_WARNING, CV_CRITICAL = 10.0, 20.0
ALERT_PCT = 5.0
COVERAGE_MIN = 5
HIGH_PRICE = 30_000.0
# ------------------------------------------------------------------------------------------

VALID_COMMODITIES = [*LABELS, GENERAL]


def commodity_dim(spark: SparkSession) -> DataFrame:
    """One row per commodity: label, unit, reference price."""
    rows = [(k, v, UNITS.get(k, DEFAULT_UNIT), REFERENCE_PRICES[k]) for k, v in LABELS.items()]
    return spark.createDataFrame(rows, "commodity string, label string, unit string, ref_price long")
