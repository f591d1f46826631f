"""Class labels derived from numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewatch import dims


def volatility_status(index: Column, warning: float = dims.CV_WARNING, critical: float = dims.CV_CRITICAL) -> Column:
    """A null index falls through to NORMAL."""
    return F.when(index > critical, "CRITICAL").when(index > warning, "WARNING").otherwise("NORMAL")


def severity(status: Column) -> Column:
    """0 for normal, 1 for warning, 2 for critical: what tables and charts colour by."""
    return F.when(status == "CRITICAL", 2).when(status == "WARNING", 1).otherwise(0)


def recommendation(index: Column) -> Column:
    status = volatility_status(index)
    return (
        F.when(status == "CRITICAL", "intervene in the supply chain now")
        .when(status == "WARNING", "monitor closely and check stock")
        .otherwise("stable, keep routine monitoring")
    )


def high_price(avg_price: Column, limit: float = dims.HIGH_PRICE) -> Column:
    return avg_price > limit


def direction(pct: Column) -> Column:
    return F.when(pct > 0, "UP").when(pct < 0, "DOWN").otherwise("FLAT")


def arrow(pct: Column) -> Column:
    """Symbol for a signed change, a blank when there is none."""
    return F.when(pct.isNull(), " ").when(pct > 0, "↑").when(pct < 0, "↓").otherwise("→")


def alert_status(pct: Column, threshold: float = dims.ALERT_PCT) -> Column:
    return (
        F.when(pct > threshold, "SIGNIFICANT_RISE")
        .when(pct < -threshold, "SIGNIFICANT_FALL")
        .otherwise("NORMAL")
    )


def coverage_class(count: Column, index: Column, no_price: bool = False) -> Column:
    """Coverage against volatility. A null count or index reaches the last branch; with
    ``no_price`` a missing index gets a class of its own."""
    many, few = count > dims.COVERAGE_MIN, count <= dims.COVERAGE_MIN
    wild, calm = index > dims.CV_WARNING, index <= dims.CV_WARNING
    out = (
        F.when(many & wild, "HIGH_COV_HIGH_VOL")
        .when(many & calm, "HIGH_COV_LOW_VOL")
        .when(few & wild, "LOW_COV_HIGH_VOL")
    )
    if no_price:
        out = out.when(index.isNull(), "NO_PRICE")
    return out.otherwise("LOW_COV_LOW_VOL")


def coverage_note(count: Column, index: Column) -> Column:
    """Follow-up sentence for a coverage class; null when nothing needs saying."""
    many, wild = count > dims.COVERAGE_MIN, index > dims.CV_WARNING
    return (
        F.when(many & wild, "often reported and very volatile")
        .when(many, "media attention, keep monitoring")
        .when(wild, "volatile with little coverage")
    )
