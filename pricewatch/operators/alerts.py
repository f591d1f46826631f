"""Early warnings: change against the previous observation of the same commodity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewatch import dims
from pricewatch.functions import classes, numbers
from pricewatch.operators.clean import priced
from pricewatch.operators.slices import sliced_window

ORDER = ["event_time", "message_id"]


def with_previous(prices: DataFrame, keep: tuple[str, ...] = ("hour",), **limits: int) -> DataFrame:
    """Add ``prev_price``, equal times being ordered by message id. ``limits``: the sliced window's
    number of ``slices``."""
    rows = priced(prices, "event_time").select("commodity", *ORDER, "price", *keep)
    exprs = {"prev_price": lambda w: F.lag("price", 1).over(w)}
    return sliced_window(rows, ["commodity"], ORDER, 1, exprs, **limits)


def classify_changes(df: DataFrame, threshold: float = dims.ALERT_PCT, keep: Column | None = None) -> DataFrame:
    """The significant changes, and the rows that ``keep`` names.

    A change is significant if its rounded percentage, without its sign, exceeds the threshold. The sign is the direction. A row
    without a previous price has no percentage and no change.
    """
    pct = F.col("pct_change")
    wanted = F.abs(pct) > threshold
    return (
        df.select("*", numbers.change_pct(F.col("price"), F.col("prev_price")).alias("pct_change"))
        .filter(wanted if keep is None else wanted | keep)
        .select("*", classes.direction(pct).alias("direction"), classes.alert_status(pct, threshold).alias("status"), F.to_date("event_time").alias("obs_date"))
    )


ALERT_COLUMNS = [
    "commodity", "price", "prev_price", "pct_change", "direction", "status", "obs_date", "hour", "event_time",
]


def price_alert(prices: DataFrame, threshold: float = dims.ALERT_PCT, **limits: int) -> DataFrame:
    """Alert table for raw observations of any number per commodity."""
    return classify_changes(with_previous(prices, **limits), threshold).select(*ALERT_COLUMNS)


def price_alert_daily(daily: DataFrame, threshold: float = dims.ALERT_PCT) -> DataFrame:
    """Alert table for one row per commodity and day.

    The rows of a commodity are bounded by the number of days, so the plain window is safe.
    """
    window = Window.partitionBy("commodity").orderBy(*ORDER)
    rows = priced(daily, "event_time").withColumn("prev_price", F.lag("price", 1).over(window))
    return classify_changes(rows, threshold).select(*ALERT_COLUMNS)


def daily_mean(prices: DataFrame) -> DataFrame:
    """Mean price per commodity and day, as observations at midnight."""
    day = F.to_date("event_time")
    return (
        priced(prices, "event_time")
        .groupBy("commodity", day.alias("obs_date"))
        .agg(F.round(F.avg("price"), 2).alias("price"))
        .select(
            F.concat_ws("|", "commodity", F.date_format("obs_date", "yyyy-MM-dd")).alias("message_id"),
            "commodity",
            "price",
            F.col("obs_date").cast("timestamp_ntz").alias("event_time"),
            F.lit(0).alias("hour"),
            F.dayofweek("obs_date").alias("dow"),
            F.date_format("obs_date", "yyyy-MM-dd").alias("day"),
        )
    )


def alert_last3(prices: DataFrame, threshold: float = dims.ALERT_PCT, **limits: int) -> DataFrame:
    """Rise above the lowest of the last three observations."""
    rows = priced(prices, "event_time").select("commodity", *ORDER, "price")
    exprs = {"low3": lambda w: F.min("price").over(w.rowsBetween(-3, -1))}
    low = sliced_window(rows, ["commodity"], ORDER, 3, exprs, **limits)
    return low.withColumn("rise_pct", numbers.change_pct(F.col("price"), F.col("low3"))).filter(
        F.col("rise_pct") > threshold
    )


def rolling_mean(prices: DataFrame, back: int = 2, **limits: int) -> DataFrame:
    """Mean of the current and the ``back`` previous observations."""
    rows = priced(prices, "event_time").select("commodity", *ORDER, "price")
    exprs = {"rolling_avg": lambda w: F.round(F.avg("price").over(w.rowsBetween(-back, 0)), 2)}
    return sliced_window(rows, ["commodity"], ORDER, back, exprs, **limits)
