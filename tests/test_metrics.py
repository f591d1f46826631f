"""Volatility, trend, correlation and classes on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from pricewatch.functions import classes, numbers, text
from pricewatch.operators import correlate, enrich, quality, stats, volatility


def prices(spark, rows):
    return spark.createDataFrame(rows, "commodity string, label string, price double")


def test_single_observation(spark):
    row = volatility.cv_volatility(prices(spark, [("beras", "Beras", 5000.0)])).first()
    assert (row.stddev_price, row.cv_index, row.status, row.n_obs) == (None, 0.0, "NORMAL", 1)


def test_cv_uses_rounded_inputs(spark):
    df = prices(spark, [("a", "A", 1.0), ("a", "A", 1.01), ("a", "A", 1.013), ("a", "A", -5.0), ("a", "A", None)])
    row = volatility.cv_volatility(df).first()
    assert (row.mean_price, row.stddev_price, row.n_obs) == (1.01, 0.01, 3)
    assert row.cv_index == 0.99
    assert volatility.cv_stats(df, mean_scale=0).first().cv_index == 1.0


def test_nan_policies(spark):
    df = prices(spark, [("a", "A", 10.0), ("a", "A", 20.0), ("a", "A", float("nan"))])
    zero = volatility.range_volatility(df, "zero").first()
    null = volatility.range_volatility(df).first()
    assert (zero.min_price, zero.avg_price, zero.range_index, zero.n_obs) == (0.0, 10.0, 200.0, 3)
    assert (null.min_price, null.avg_price, null.range_index, null.n_obs) == (10.0, 15.0, 66.67, 2)
    assert volatility.range_volatility(prices(spark, [("z", "Z", 0.0)])).first().range_index == 0.0
    with pytest.raises(ValueError):
        volatility.range_volatility(df, "drop")


def test_half_up_rounding(spark):
    got = spark.range(1).select(*[F.round(F.lit(x), 2).alias(str(i)) for i, x in enumerate((1.005, 2.675, 0.125))]).first()
    assert tuple(got) == (1.01, 2.68, 0.13)


def test_status_boundaries(spark):
    df = spark.createDataFrame([(10.0,), (10.01,), (20.0,), (20.01,), (None,)], "i double")
    got = [tuple(r) for r in df.select(classes.volatility_status(F.col("i")), classes.severity(classes.volatility_status(F.col("i")))).collect()]
    assert got == [("NORMAL", 0), ("WARNING", 1), ("WARNING", 1), ("CRITICAL", 2), ("NORMAL", 0)]


def test_coverage_boundaries(spark):
    cases = [(5, 10.0), (5, 10.01), (6, 10.0), (6, 10.01), (6, None), (None, 50.0)]
    df = spark.createDataFrame(cases, "n int, i double")
    want = ["LOW_COV_LOW_VOL", "LOW_COV_HIGH_VOL", "HIGH_COV_LOW_VOL", "HIGH_COV_HIGH_VOL", "LOW_COV_LOW_VOL", "LOW_COV_LOW_VOL"]
    assert [r[0] for r in df.select(classes.coverage_class(F.col("n"), F.col("i"))).collect()] == want
    flagged = [r[0] for r in df.select(classes.coverage_class(F.col("n"), F.col("i"), no_price=True)).collect()]
    assert flagged == want[:4] + ["NO_PRICE", "LOW_COV_LOW_VOL"]


def test_dayparts(spark):
    hours = [0, 5, 6, 12, 13, 18, 19, 23]
    df = spark.createDataFrame([("a", h) for h in hours] + [(None, 7)], "commodity string, hour int")
    row = correlate.news_counts(df).first()
    assert (row.n_news, row.news_morning, row.news_afternoon, row.news_evening) == (8, 2, 2, 2)


def test_news_without_prices(spark):
    news = spark.createDataFrame([("a", 7)] * 6, "commodity string, hour int")
    row = correlate.news_price_correlation(news, prices(spark, [("b", "B", 1.0)])).first()
    assert (row.commodity, row.n_news, row.status, row.coverage_class) == ("a", 6, None, "LOW_COV_LOW_VOL")


def test_mentions_of_unlisted_commodity(spark):
    ranges = volatility.range_volatility(prices(spark, [("kopi", "Kopi", 1.0), ("kopi", "Kopi", 9.0)]))
    news = spark.createDataFrame([("harga beras",)], "title string")
    row = correlate.mention_correlation(ranges, news).first()
    assert (row.n_mentions, row.coverage_class) == (0, "LOW_COV_LOW_VOL")


def test_pair_counts_equal_the_join(spark):
    p = prices(spark, [("a", "A", 1.0)] * 3 + [("b", "B", 1.0)] * 2 + [("c", "C", 1.0)])
    n = spark.createDataFrame([("a", 1)] * 4 + [("b", 1)], "commodity string, hour int")
    got = {r.commodity: r.n_pairs for r in correlate.pair_counts(p, n).collect()}
    assert got == {r.commodity: r["count"] for r in p.join(n, "commodity").groupBy("commodity").count().collect()}


def test_keyword_order_and_modes(spark):
    df = spark.createDataFrame([("Harga TAHUN ini",), ("padi dan jagung",), ("harga cpo",), ("tahu goreng",), ("lain",)], "t string")
    tag = [r.commodity for r in enrich.keyword_tag(df, F.col("t")).collect()]
    assert tag == ["kedelai", "beras", "minyak_goreng", "kedelai", "umum"]
    words = [r.commodity for r in enrich.keyword_tag(df, F.col("t"), whole_words=True).collect()]
    assert words == ["umum", "beras", "minyak_goreng", "kedelai", "umum"]


def test_long_text_is_read_whole(spark):
    df = spark.createDataFrame([("x " * 100_000 + "gabah",)], "t string")
    assert enrich.keyword_tag(df, F.col("t")).first().commodity == "beras"


def test_mention_counts_with_zero(spark):
    df = spark.createDataFrame([("beras dan bawang",), ("Beras",), (None,)], "title string")
    got = {r.commodity: r.n_mentions for r in enrich.mention_counts(df).collect()}
    assert got["beras"] == 2 and got["bawang_merah"] == 1 and got["telur"] == 0 and len(got) == 8


def test_names_and_text(spark):
    df = spark.createDataFrame([(" Beras Premium\t",), ("Cabe Rawit",), ("Daging Sapi Lokal",), ("telur",)], "n string")
    got = [r[0] for r in df.select(enrich.normalise_name(F.col("n"))).collect()]
    assert got == ["beras", "cabai", "daging_sapi_lokal", "telur"]
    one = spark.createDataFrame([("  <p>a <b>b</b>\n</p>　",)], "h string")
    assert one.select(text.strip_tags(F.col("h"))).first()[0] == "a b"


def test_local_price(spark):
    df = spark.createDataFrame([("jagung", 200.0), ("gula", 20.0), ("telur", 1.0)], "c string, v double")
    got = [r[0] for r in df.select(F.round(numbers.local_price(F.col("v"), F.col("c")), 2)).collect()]
    assert got == [5688.0, 695.2, 23.7]


def test_safe_numbers(spark):
    df = spark.createDataFrame([("1.005",), ("abc",), (None,), ("NaN",), ("-Infinity",), ("7",)], "s string")
    got = [tuple(r) for r in df.select(numbers.safe_float(F.col("s")), numbers.safe_int(F.col("s"))).collect()]
    assert got == [(1.01, 0), (0.0, 0), (0.0, 0), (0.0, 0), (0.0, 0), (7.0, 7)]


def test_source_priority(spark):
    schema = "commodity string, price double"
    first = spark.createDataFrame([("a", 1.0), ("a", 2.0)], schema)
    second = spark.createDataFrame([("a", 9.0), ("b", 3.0)], schema)
    third = spark.createDataFrame([("b", 8.0), ("c", 4.0)], schema)
    empty = spark.createDataFrame([], schema)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(enrich.priority_fill([first, second, third])) == [("a", 1.0), ("a", 2.0), ("b", 3.0), ("c", 4.0)]
    assert rows(enrich.first_available([first, second, third])) == [("a", 1.0), ("a", 2.0)]
    assert rows(enrich.first_available([empty, second, third])) == [("a", 9.0), ("b", 3.0), ("c", 4.0)]
    assert rows(enrich.first_available([empty, empty, third])) == [("b", 8.0), ("c", 4.0)]


def test_indicator_and_list_responses(spark):
    today = F.lit("2026-03-06 00:00:00").cast("timestamp_ntz")
    bodies = ['[{}, [{"value": 200.0, "date": "2026M02"}]]', '[{}, [{"value": null}]]', "[{}, []]", "[{}]", "oops"]
    raw = spark.createDataFrame([("jagung", b) for b in bodies], "commodity string, body string")
    rows = enrich.indicator_records(raw, "indicator", today).collect()
    assert [(r.price, r.obs_date, r.label, r.unit) for r in rows] == [(5688.0, "2026M02", "Jagung", "kg")]
    item = "struct<nama_komoditi:string,harga_rata:string,harga:string,wilayah:string>"
    data = [[("Minyak Goreng", "17000", "1", None), ("Beras Medium", None, "14000", "Jawa"), ("Beras", "0", "5", None), ("Kopi", "9", None, None), ("Telur", None, None, None)]]
    listed = enrich.price_list_records(spark.createDataFrame([(d,) for d in data], f"data array<{item}>"), today, "list")
    got = sorted((r.commodity, r.price, r.region, r.unit) for r in listed.collect())
    assert got == [("beras", 14000.0, "Jawa", "kg"), ("minyak_goreng", 17000.0, "Nasional", "liter")]


def test_quality(spark):
    df = prices(spark, [("a", None, 1.0), ("b", "B", 3.0)])
    rows = {r.column_name: r for r in quality.profile(df).collect()}
    assert (rows["label"].n_nulls, rows["price"].min_value, rows["price"].max_value) == (1, "1.0", "3.0")
    assert [(r.column_name, r.present) for r in quality.schema_check(df, ["price", "x"]).collect()] == [("price", True), ("x", False)]
    assert quality.cardinality_check(df, "commodity", 8).first().ok is False


def test_clusters_are_ordered_by_price(spark):
    rows = [(f"c{i}", f"2024-01-0{d}", 100.0 + i if i < 3 else 5000.0 + i) for i in range(6) for d in (1, 2)]
    df = spark.createDataFrame(rows, "commodity string, d string, price double").withColumn("event_time", F.col("d").cast("timestamp_ntz"))
    got = {(r.commodity, r.cluster) for r in stats.trend_clusters(df, k=2).select("commodity", "cluster").collect()}
    assert got == {(f"c{i}", int(i >= 3)) for i in range(6)}


def test_anomaly_and_slope(spark):
    rows = [(f"m{d}", "a", 10.0 + d, f"2024-01-{d + 1:02d}") for d in range(20)] + [("m99", "a", 1000.0, "2024-01-25")]
    df = spark.createDataFrame(rows, "message_id string, commodity string, price double, d string")
    df = df.withColumn("event_time", F.col("d").cast("timestamp_ntz"))
    assert [r.message_id for r in stats.zscore_anomaly(df).collect()] == ["m99"]
    line = stats.trend_slope(df.filter("price < 1000")).first()
    assert (line.slope_per_day, line.intercept) == (1.0, 10.0)
