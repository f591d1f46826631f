"""Distinct counts that merge: HyperLogLog sketches per commodity and day.

A sketch is some kilobytes however many values it has seen, so the distinct values of any span of days come from the union of the days'
sketches, without another look at the rows. The relative standard error is about 1.04 / sqrt(2 ** precision).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRECISION = 12
#: Standard errors within which an estimate is expected to lie.
SIGMAS = 4


def daily_sketches(rows: DataFrame, value: Column, keys: list[str], precision: int = PRECISION) -> DataFrame:
    """One sketch per group; groups without a value have an empty one."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(value, precision).alias("sketch"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate() -> Column:
    return F.hll_sketch_estimate("sketch")


def error_bound(precision: int = PRECISION) -> float:
    """Largest relative error to expect."""
    return SIGMAS * 1.04 / 2 ** (precision / 2)
