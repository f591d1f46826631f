"""Fixed schemas as DDL text; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: field names on the wire, type, and the column they become ---------------
_PRICE_FIELDS = [
    ("message_id", "string", "message_id"),
    ("schema_version", "string", "schema_version"),
    ("komoditas", "string", "commodity"),
    ("label", "string", "label"),
    ("harga", "double", "price"),
    ("satuan", "string", "unit"),
    ("wilayah", "string", "region"),
    ("harga_acuan", "bigint", "ref_price"),
    ("perubahan_pct", "double", "ref_change_pct"),
    ("sumber", "string", "source_name"),
    ("ada_shock", "boolean", "is_shock"),
    ("tanggal", "string", "obs_date"),
    ("jam", "string", "obs_time"),
    ("timestamp_iso", "string", "ts_iso"),
    ("timestamp_unix", "bigint", "ts_unix"),
    ("pipeline", "string", "pipeline"),
    ("topic", "string", "topic"),
]
_NEWS_FIELDS = [
    ("title", "string", "title"),
    ("link", "string", "link"),
    ("summary", "string", "summary"),
    ("published", "string", "published"),
    ("source_feed", "string", "source_feed"),
    ("timestamp", "string", "ts_text"),
]
# ------------------------------------------------------------------------------------------

WIRE_NAMES = {wire: ours for wire, _, ours in _PRICE_FIELDS + _NEWS_FIELDS}


def _ddl(fields: list[tuple[str, str, str]], wire: bool = False) -> str:
    return ", ".join(f"`{w if wire else o}` {t}" for w, t, o in fields)


#: Both message kinds in one row shape, absent fields null.
MIXED = _ddl(_PRICE_FIELDS + _NEWS_FIELDS)
MIXED_WIRE = _ddl(_PRICE_FIELDS + _NEWS_FIELDS, wire=True)
MIXED_COLUMNS = [ours for _, _, ours in _PRICE_FIELDS + _NEWS_FIELDS]
#: Raw table: the mixed shape plus provenance.
BRONZE_COLUMNS = [*MIXED_COLUMNS, "_ingested_at", "_source"]


def to_mixed(df: DataFrame) -> DataFrame:
    """The mixed shape of a DataFrame that has some of its columns; the others become null."""
    have = set(df.columns)
    return df.select(
        *[(F.col(o) if o in have else F.lit(None)).cast(t).alias(o) for _, t, o in _PRICE_FIELDS + _NEWS_FIELDS]
    )
