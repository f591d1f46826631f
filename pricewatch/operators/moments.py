"""Mergeable price statistics: one small table feeds dispersion, trend, correlation and weekly figures.

A row holds the count, the sum, the sum of squared distances from the mean, the lowest and the highest price of a group. Rows of finer groups,
such as commodity and hour, give those of coarser ones exactly, without another look at the prices: sums add up, and the squared
distances add up with what the parallel variance formula puts in for two groups of different means.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ["n_obs", "total", "squares", "low", "high"]


def collect(prices: DataFrame, keys: list[str], price: Column | None = None) -> DataFrame:
    """The statistics of each group; partial sums before the shuffle."""
    p = price if price is not None else F.col("price")
    n = F.count(p)
    return prices.groupBy(*keys).agg(n.alias("n_obs"), F.sum(p).alias("total"), (F.var_pop(p) * n).alias("squares"), F.min(p).alias("low"), F.max(p).alias("high"))


def _both(a: Column, b: Column) -> Column:
    """Statistics of two groups put together; either may be empty."""
    n = a.n_obs + b.n_obs
    apart = F.try_divide(b.total, b.n_obs) - F.try_divide(a.total, a.n_obs)
    between = F.coalesce(apart * apart * (a.n_obs * b.n_obs / n), F.lit(0.0))
    return F.struct(
        n.alias("n_obs"),
        (a.total + F.coalesce(b.total, F.lit(0.0))).alias("total"),
        (a.squares + F.coalesce(b.squares, F.lit(0.0)) + between).alias("squares"),
        F.least(a.low, b.low).alias("low"),
        F.greatest(a.high, b.high).alias("high"),
    )


def combine(moments: DataFrame, keys: list[str]) -> DataFrame:
    """The statistics of coarser groups. Each gathers the rows of its finer ones, one a period and label, in a fixed order."""
    parts = F.sort_array(F.collect_list(F.struct(*FIELDS)))
    none = F.expr("named_struct('n_obs', 0L, 'total', 0D, 'squares', 0D, 'low', cast(null as double), 'high', cast(null as double))")
    return moments.groupBy(*keys).agg(F.aggregate(parts, none, _both).alias("m")).select(*keys, "m.*")


def mean() -> Column:
    return F.try_divide(F.col("total"), F.col("n_obs"))


def deviation() -> Column:
    """Sample deviation; null for fewer than two prices."""
    return F.when(F.col("n_obs") > 1, F.sqrt(F.col("squares") / (F.col("n_obs") - 1)))
