"""Sliced windows and newest-N against plain windows, with hot keys and ties."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricewatch.operators import alerts, slices

SCHEMA = "commodity string, event_time timestamp_ntz, message_id string, price double"


def ticks(spark, n, seed, instants, hot=0.6, commodities=4):
    """``hot`` of the rows belong to one commodity; few instants give many equal times."""
    import datetime as dt

    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        c = "hot" if rng.random() < hot else f"c{rng.randrange(commodities)}"
        rows.append((c, start + dt.timedelta(minutes=rng.randrange(instants)), f"id{i:05d}", float(rng.randrange(1, 500))))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("instants", [1, 7, 100000])
@pytest.mark.parametrize("n_slices", [1, 5, 40])
@pytest.mark.parametrize("depth", [1, 3])
def test_sliced_window_equals_plain(spark, instants, n_slices, depth):
    df = ticks(spark, 400, instants + depth, instants)
    exprs = {
        "prev": lambda w: F.lag("price", depth).over(w),
        "low": lambda w: F.min("price").over(w.rowsBetween(-depth, -1)),
    }
    order = ["event_time", "message_id"]
    got = slices.sliced_window(df, ["commodity"], order, depth, exprs, slices=n_slices)
    plain = Window.partitionBy("commodity").orderBy(*order)
    want = df.select("*", *[make(plain).alias(k) for k, make in exprs.items()])
    assert got.count() == df.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_window_of_nothing(spark):
    exprs = {"prev": lambda w: F.lag("price", 1).over(w)}
    none = spark.createDataFrame([], SCHEMA)
    assert slices.sliced_window(none, ["commodity"], ["event_time", "message_id"], 1, exprs).count() == 0


def test_hot_key_is_spread_over_slices(spark):
    df = ticks(spark, 4000, 1, 1, hot=1.0)
    ranged = df.repartitionByRange(8, "commodity", "event_time", "message_id")
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


def test_fewer_rows_than_depth(spark):
    df = ticks(spark, 12, 5, 100, hot=0.2, commodities=8)
    got = slices.sliced_window(
        df, ["commodity"], ["event_time", "message_id"], 3, {"n": lambda w: F.count("price").over(w.rowsBetween(-3, -1))}, slices=12
    )
    plain = Window.partitionBy("commodity").orderBy("event_time", "message_id").rowsBetween(-3, -1)
    want = df.withColumn("n", F.count("price").over(plain))
    assert got.exceptAll(want).isEmpty() and got.count() == 12


def test_newest_per_key(spark):
    df = ticks(spark, 500, 9, 50).repartition(20)
    order = [F.desc("event_time"), F.asc("message_id")]
    got = slices.newest_per_key(df, ["commodity"], order, 7)
    plain = Window.partitionBy("commodity").orderBy(*order)
    want = df.withColumn("rank", F.row_number().over(plain)).filter("rank <= 7")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_alert_boundaries(spark):
    """Exactly 5 % and 5.004 % are no alert; 5.006 % and -5.01 % are."""
    pairs = {"a": 105.0, "b": 105.004, "c": 105.006, "d": 94.99, "e": 105.01}
    rows = [(c, f"2024-01-0{d}", f"{c}{d}", p) for c, new in pairs.items() for d, p in ((1, 100.0), (2, new))]
    df = spark.createDataFrame(rows, "commodity string, d string, message_id string, price double").select(
        "commodity", F.col("d").cast("timestamp_ntz").alias("event_time"), "message_id", "price", F.lit(0).alias("hour")
    )
    out = {r.commodity: (r.pct_change, r.status, r.direction) for r in alerts.price_alert(df).collect()}
    assert out == {
        "c": (5.01, "SIGNIFICANT_RISE", "UP"),
        "d": (-5.01, "SIGNIFICANT_FALL", "DOWN"),
        "e": (5.01, "SIGNIFICANT_RISE", "UP"),
    }
    assert all(abs(r[0]) > 5 for r in out.values())
