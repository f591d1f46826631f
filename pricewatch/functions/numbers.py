"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewatch import dims


def finite(c: Column) -> Column:
    """The value, or null when it is NaN or infinite."""
    bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(~bad, c)


def parsed(c: Column) -> Column:
    """Text or number as a double; null unless the text is a plain decimal, NaN or infinity. (A cast
    alone also takes type suffixes such as ``5d``.)"""
    plain = r"(?i)^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|nan|[+-]?inf(inity)?)\s*$"
    return F.when(c.cast("string").rlike(plain), c.try_cast("double"))


def nan_as(c: Column, policy: str) -> Column:
    """NaN prices: ``zero`` counts them as 0.0, ``null`` leaves them out of every aggregate."""
    if policy not in ("zero", "null"):
        raise ValueError(f"unknown NaN policy {policy!r}")
    return F.when(F.isnan(c), F.lit(0.0 if policy == "zero" else None).cast("double")).otherwise(c)


def safe_float(c: Column) -> Column:
    """Two decimals; null, unparsable, NaN and infinite values become 0.0."""
    return F.coalesce(F.round(finite(parsed(c)), 2), F.lit(0.0))


def safe_int(c: Column) -> Column:
    """Whole number; null and unparsable values become 0."""
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """``part / whole * 100`` rounded half up; null when the whole is 0 or null."""
    return F.round(F.try_divide(part, whole) * 100, scale)


def change_pct(now: Column, before: Column, scale: int = 2) -> Column:
    return percent(now - before, before, scale)


def range_pct(low: Column, high: Column) -> Column:
    """Spread relative to the low end; 0 when the low end is not positive."""
    return F.when(low > 0, F.try_divide(high - low, low) * 100).otherwise(F.lit(0.0))


def local_price(value: Column, commodity: Column, markup: dict[str, float] | None = None) -> Column:
    """World price to local retail price per kg, with a markup per commodity."""
    factor = F.lit(dims.DEFAULT_MARKUP)
    for key, m in (markup or dims.MARKUP).items():
        factor = F.when(commodity == key, F.lit(m)).otherwise(factor)
    return value * dims.USD_RATE * factor / 1000
