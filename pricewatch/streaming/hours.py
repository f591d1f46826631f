"""Hourly prices of a stream, in two forms.

* :func:`closed_hours` publishes each hour once, when the watermark has passed its end: event-time windows in append mode. Spark drops rows
  that come after that.
* :func:`partial_sums` keeps every row of any age, as sums per batch that are merged into wider spans as they pile up, so that
  :func:`totals` reads a bounded number of folders.

:func:`standing` puts both together: what was published, what late rows have changed since, and hours still open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pricewatch.operators import clean
from pricewatch.session import keyed_state
from pricewatch.streaming import spans

HOURS = "commodity string, hour_start timestamp_ntz, total double, n_obs bigint, low double, high double"


def _sums(price: Column) -> list[Column]:
    return [F.sum(price).alias("total"), F.count(price).alias("n_obs"), F.min(price).alias("low"), F.max(price).alias("high")]


def merged(parts: DataFrame) -> DataFrame:
    """Sums of sums, one row per commodity and hour."""
    return parts.groupBy("commodity", "hour_start").agg(F.sum("total").alias("total"), F.sum("n_obs").alias("n_obs"), F.min("low").alias("low"), F.max("high").alias("high"))


def partial_sums(stream: DataFrame, path: str, time_column: str = "event_time") -> DataStreamWriter:
    """Sum, count, low and high per commodity and hour of each batch, of rows of any age."""

    def write(batch: DataFrame, batch_id: int) -> None:
        hour = F.date_trunc("hour", F.col(time_column)).cast("timestamp_ntz").alias("hour_start")
        spans.write(clean.priced(batch, time_column).groupBy("commodity", hour).agg(*_sums(F.col("price"))), path, batch_id, merged)

    return stream.writeStream.foreachBatch(write)


def totals(spark: SparkSession, path: str) -> DataFrame:
    """Hourly mean, low, high and count per commodity over all batches so far."""
    return _prices(merged(spans.read(spark, path, HOURS)))


def _prices(sums: DataFrame) -> DataFrame:
    return sums.select(
        "commodity",
        "hour_start",
        F.round(F.col("total") / F.col("n_obs"), 0).alias("avg_price"),
        F.round("low", 0).alias("min_price"),
        F.round("high", 0).alias("max_price"),
        "n_obs",
    )


def closed_hours(stream: DataFrame, path: str, delay: str = "1 hour", time_column: str = "event_time") -> DataStreamWriter:
    """Each hour once, ``delay`` after its end in event time; rows later than that are in :func:`partial_sums` only."""
    keyed_state(stream.sparkSession)
    rows = clean.priced(stream, time_column).withColumn("_at", F.col(time_column).cast("timestamp")).withWatermark("_at", delay)
    hours = rows.groupBy(F.window("_at", "1 hour"), "commodity").agg(*_sums(F.col("price")))
    out = hours.select("commodity", F.col("window.start").cast("timestamp_ntz").alias("hour_start"), "total", "n_obs", "low", "high")
    return out.writeStream.format("parquet").outputMode("append").option("path", path)


def standing(spark: SparkSession, sums_path: str, closed_path: str) -> DataFrame:
    """Every hour as it stands, with its state: ``closed`` as published, ``corrected`` by late rows since, ``late`` where all its rows came
    after its time, ``open`` where it has not been published yet."""
    published = spark.read.schema(HOURS).parquet(closed_path)
    newest = published.agg(F.max("hour_start")).first()[0]
    now = merged(spans.read(spark, sums_path, HOURS))
    before = published.select("commodity", "hour_start", F.col("n_obs").alias("_n"))
    passed = F.col("hour_start") <= F.lit(newest).cast("timestamp_ntz")
    state = (
        F.when(F.col("_n") == F.col("n_obs"), "closed")
        .when(F.col("_n").isNotNull(), "corrected")
        .when(F.coalesce(passed, F.lit(False)), "late")
        .otherwise("open")
    )
    return _prices(now).join(before, ["commodity", "hour_start"], "left").withColumn("state", state).drop("_n")
