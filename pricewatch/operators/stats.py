"""Further statistics: anomalies, weekly dispersion, linear trend, clusters, fill rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.functions import classes, numbers, times
from pricewatch.operators import moments
from pricewatch.operators.clean import priced
from pricewatch.session import stored


def zscore_anomaly(prices: DataFrame, limit: float = 3.0) -> DataFrame:
    """Observations more than ``limit`` deviations from their commodity's mean."""
    rows = priced(prices).select("message_id", "commodity", "price", "event_time")
    stats = rows.groupBy("commodity").agg(F.avg("price").alias("mean"), F.stddev("price").alias("dev"))
    z = F.round(F.try_divide(F.col("price") - F.col("mean"), F.col("dev")), 3)
    return (
        rows.join(stats, "commodity")
        .withColumn("zscore", z)
        .filter(F.abs("zscore") > limit)
        .drop("mean", "dev")
    )


def weekly_volatility(prices: DataFrame, unit: str = "week") -> DataFrame:
    """Coefficient of variation per commodity and calendar period (week or day)."""
    daily = priced(prices, "event_time").withColumn("obs_date", F.to_date("event_time"))
    return period_volatility(moments.collect(daily, ["commodity", "obs_date"]), unit)


def period_volatility(stats: DataFrame, unit: str = "week") -> DataFrame:
    """The same from a moments table with ``obs_date``."""
    period = F.date_trunc(unit, F.col("obs_date").cast("timestamp_ntz")).cast("date")
    merged = moments.combine(stats.withColumn("period", period), ["commodity", "period"])
    rounded = merged.select("commodity", "period", F.round(moments.mean(), 2).alias("mean_price"), F.round(moments.deviation(), 2).alias("stddev_price"), "n_obs")
    index = F.coalesce(numbers.percent(F.col("stddev_price"), F.col("mean_price")), F.lit(0.0))
    return rounded.select("*", index.alias("cv_index"), classes.volatility_status(index).alias("status"))


def trend_slope(prices: DataFrame, origin: str = "2024-01-01 00:00:00") -> DataFrame:
    """Least-squares line per commodity: price change per day since ``origin``."""
    start = times.epoch_seconds(F.lit(origin).cast("timestamp_ntz"))
    days = (times.epoch_seconds(F.col("event_time")) - start) / F.lit(86400.0)
    return (
        priced(prices, "event_time")
        .withColumn("days", days)
        .groupBy("commodity")
        .agg(
            F.round(F.regr_slope("price", "days"), 4).alias("slope_per_day"),
            F.round(F.regr_intercept("price", "days"), 4).alias("intercept"),
            F.count("price").alias("n_obs"),
        )
    )


def trend_clusters(
    prices: DataFrame, k: int = 2, tries: int = 5, features: tuple[str, ...] = ("mean_price", "cv_index")
) -> DataFrame:
    """K-means over commodity-days by ``features``; cluster numbers follow the first of them.

    A start can end in a local optimum, so the cheapest of several seeded ``tries`` is taken.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    points = weekly_volatility(prices, "day").select("commodity", "period", "mean_price", "cv_index")
    points = VectorAssembler(inputCols=list(features), outputCol="features").transform(points)
    points = stored(points, "cluster-points")
    means = KMeans(k=k, maxIter=100, tol=0.0, featuresCol="features", predictionCol="cluster")
    fits = [means.copy({means.seed: seed}).fit(points) for seed in range(1, tries + 1)]
    model = min(fits, key=lambda m: m.summary.trainingCost)
    order = sorted(range(k), key=lambda i: tuple(model.clusterCenters()[i]))
    renumber = F.array(*[F.lit(order.index(i)) for i in range(k)])
    out = model.transform(points).drop("features")
    return out.withColumn("cluster", F.element_at(renumber, F.col("cluster") + 1))


def fill_standardise(df: DataFrame, fills: dict[str, object], upper: list[str]) -> DataFrame:
    """Null fill and upper-case standard form, with runs of white space made one blank."""
    out = df.fillna(fills)
    return out.withColumns({c: F.regexp_replace(F.upper(F.trim(c)), r"\s+", " ") for c in upper})
