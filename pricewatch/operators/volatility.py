"""Price dispersion, trend and distribution tables. All are hash aggregates with partial sums, so a
commodity with many rows is reduced before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.functions import classes, numbers
from pricewatch.operators import moments
from pricewatch.operators.clean import priced


def cv_table(stats: DataFrame, mean_scale: int = 2) -> DataFrame:
    """Dispersion table of a moments table with one row per commodity.

    The index is the ratio of the rounded figures. ``status`` is decided on it before a missing index (one observation) becomes 0.
    """
    shown = stats.filter("n_obs > 0").select(
        "commodity",
        F.round(moments.mean(), mean_scale).alias("mean_price"),
        F.round(moments.deviation(), 2).alias("stddev_price"),
        *(F.round(c, 0).alias(name) for c, name in (("low", "min_price"), ("high", "max_price"))),
        "n_obs",
    )
    index = numbers.percent(F.col("stddev_price"), F.col("mean_price"))
    return shown.select("*", index.alias("cv_index"), classes.volatility_status(index).alias("status"))


def cv_stats(prices: DataFrame, mean_scale: int = 2) -> DataFrame:
    return cv_table(moments.collect(priced(prices), ["commodity"]), mean_scale)


def cv_volatility(prices: DataFrame) -> DataFrame:
    return filled(cv_stats(prices))


def filled(table: DataFrame) -> DataFrame:
    """The dispersion table with 0 for a missing index."""
    return table.fillna(0.0, ["cv_index"])


def range_table(stats: DataFrame) -> DataFrame:
    """Spread in per cent of the mean, from a moments table with one row per commodity and label; only what is shown is rounded."""
    mean = moments.mean()
    index = F.when(mean > 0, numbers.percent(F.col("high") - F.col("low"), mean)).otherwise(0.0)
    shown = {"max_price": F.col("high"), "min_price": F.col("low"), "avg_price": mean, "stddev_price": F.coalesce(moments.deviation(), F.lit(0.0))}
    return stats.select("commodity", "label", *(F.round(c, 2).alias(name) for name, c in shown.items()), "n_obs", index.alias("range_index"))


def range_volatility(prices: DataFrame, nan_policy: str = "null") -> DataFrame:
    return range_table(moments.collect(prices, ["commodity", "label"], numbers.nan_as(F.col("price"), nan_policy)))


def trend_summary(prices: DataFrame) -> DataFrame:
    """Lifetime price summary per (commodity, label), from one row per commodity, label and day.

    ``range_pct`` and ``is_high`` are the two remarks of the report.
    """
    rows, high, low = F.col("rows"), F.max("high"), F.min("low")
    days = (
        prices.filter(F.col("commodity").isNotNull())
        .groupBy("commodity", "label", "day")
        .agg(
            F.sum("price").alias("total"),
            F.count("price").alias("priced"),
            F.count(F.lit(1)).alias("rows"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
        )
    )
    summary = days.groupBy("commodity", "label").agg(
        F.sum(rows).alias("n_obs"),
        F.count("day").alias("n_days"),
        F.round(high, 2).alias("max_price"),
        F.round(low, 2).alias("min_price"),
        F.round(F.try_divide(F.sum("total"), F.sum("priced")), 2).alias("avg_price"),
    )
    spread = numbers.range_pct(F.col("min_price"), F.col("max_price"))
    remarks = F.round(spread, 1).alias("range_pct"), classes.high_price(F.col("avg_price")).alias("is_high")
    return summary.select("commodity", "label", "avg_price", "min_price", "max_price", "n_days", "n_obs", *remarks)


TREND_KEYS = ["commodity", "obs_date", "hour", "dow"]


def hourly_moments(prices: DataFrame) -> DataFrame:
    """Moments per commodity, date, hour and day of week: what trend, dispersion and correlation tables are made from."""
    return moments.collect(priced(prices).withColumn("obs_date", F.to_date("event_time")), TREND_KEYS)


def trend_table(stats: DataFrame) -> DataFrame:
    """Mean, low and high of each row of :func:`hourly_moments` that has a date."""
    rounded = {"avg_price": moments.mean(), "min_price": F.col("low"), "max_price": F.col("high")}
    return stats.filter("obs_date is not null").select(*TREND_KEYS, *(F.round(c, 0).alias(name) for name, c in rounded.items()), "n_obs")


def trend_periodic(prices: DataFrame) -> DataFrame:
    """Mean, low and high per commodity, date, hour and day of week."""
    return trend_table(hourly_moments(prices.filter(F.col("event_time").isNotNull())))


def distribution(df: DataFrame, column: str = "commodity", top: int = 10) -> DataFrame:
    """Most frequent values with their counts."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_first(column)).limit(top)


def most_volatile(volatility: DataFrame, index: str = "cv_index", top: int = 1) -> DataFrame:
    return volatility.orderBy(F.desc(index), "commodity").limit(top)
