"""Streams give the batch result, whatever the order of their rows, and survive restarts."""

import pytest
from pyspark.sql import functions as F

from settings import SF
from pricewatch.operators import alerts
from pricewatch.plans import queries
from pricewatch.session import drop_folder, new_dir, subfolders
from pricewatch.sources import adapters, files, streams
from pricewatch.sources.snapshots import SnapshotTable
from pricewatch.streaming import early_warning, hours, jobs, runner, spans, unique

SCHEMA = "message_id string, commodity string, price double, event_time timestamp_ntz"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """State is kept in as many stores as there are shuffle partitions; two show all that eight do."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def run_alerts(spark, root, **how):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
    runner.drain(early_warning.changes(stream, f"{root}/out", **how), f"{root}/checkpoint/changes")
    runner.drain(early_warning.edge_changes(spark, f"{root}/out"), f"{root}/checkpoint/edges")
    return early_warning.current(spark, f"{root}/out")


def test_alerts_out_of_order_equal_batch(spark):
    """Batches in no order of time, split inside days and hours, periods of a day and of a week."""
    ticks = adapters.ticks(spark, SF).select("message_id", "commodity", "price", "event_time")
    want = rows_of(alerts.price_alert(adapters.ticks(spark, SF)))
    for width, parts in ((early_warning.DAY, 3), (7 * early_warning.DAY, 2)):
        root = new_dir(spark, "alerts")
        for part in range(parts):
            ticks.filter(F.pmod(F.hash("message_id"), F.lit(parts)) == part).write.mode("append").parquet(f"{root}/in")
            got = run_alerts(spark, root, width=width)
        assert rows_of(got) == want
        assert not [name for name in subfolders(spark, f"{root}/out") if "late" in name]


def observations(spark, rows):
    df = spark.createDataFrame(rows, "message_id string, commodity string, price double, t string")
    return df.select("message_id", "commodity", "price", F.col("t").cast("timestamp_ntz").alias("event_time")).coalesce(1)


def test_a_late_row_has_its_alert_and_corrects_the_next(spark):
    root = new_dir(spark, "late")
    shown = []
    for rows in (
        [("a", "x", 10.0, "2024-01-01"), ("d", "x", 20.0, "2024-01-04"), ("n", "x", None, "2024-01-09")],
        [("b", "x", 19.5, "2024-01-02")],  # d is no alert any more
        [("c", "x", 30.0, "2024-01-02 12:00:00")],  # d falls now
        [("0", "x", 30.0, "2023-12-31"), ("e", "x", 20.0, "2024-01-04")],
    ):
        observations(spark, rows).write.mode("append").parquet(f"{root}/in")
        got = run_alerts(spark, root).orderBy("event_time", "price").collect()
        shown.append([(r.price, r.prev_price, r.direction) for r in got])
    assert shown == [
        [(20.0, 10.0, "UP")],
        [(19.5, 10.0, "UP")],
        [(19.5, 10.0, "UP"), (30.0, 19.5, "UP"), (20.0, 30.0, "DOWN")],
        [(10.0, 30.0, "DOWN"), (19.5, 10.0, "UP"), (30.0, 19.5, "UP"), (20.0, 30.0, "DOWN")],
    ]


def test_a_horizon_empties_the_state(spark):
    """Rows within the horizon count in any order; the state of closed days goes by a timer."""
    root = new_dir(spark, "horizon")
    days = [f"2024-01-{d:02d}" for d in (2, 1, 4, 3, 20, 19, 21)]
    rows = [(str(i), "x", 10.0 + 3 * i, day) for i, day in enumerate(days)]
    for row in rows:
        observations(spark, [row]).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        query = runner.start(early_warning.changes(stream, f"{root}/out", horizon="5 days"), f"{root}/checkpoint/changes", every=None)
        query.awaitTermination()
        runner.drain(early_warning.edge_changes(spark, f"{root}/out"), f"{root}/checkpoint/edges")
    left = query.lastProgress.stateOperators[0].numRowsTotal
    want = alerts.price_alert(observations(spark, rows).withColumn("hour", F.hour("event_time")))
    assert rows_of(early_warning.current(spark, f"{root}/out")) == rows_of(want)
    assert left <= 6  # three days and their timers


def test_replayed_batch_changes_nothing(spark):
    """A second run from an empty checkpoint writes the same."""
    root = new_dir(spark, "replay")
    ticks = adapters.ticks(spark, SF).select("message_id", "commodity", "price", "event_time")
    ticks.write.parquet(f"{root}/in")
    found = []
    for attempt in ("first", "second"):
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        runner.drain(early_warning.changes(stream, f"{root}/out"), f"{root}/{attempt}/changes")
        runner.drain(early_warning.edge_changes(spark, f"{root}/out"), f"{root}/{attempt}/edges")
        found.append(rows_of(early_warning.current(spark, f"{root}/out")))
    assert found[0] == found[1] == rows_of(alerts.price_alert(adapters.ticks(spark, SF)))


def test_spans_are_bounded_and_survive_replays(spark):
    root = new_dir(spark, "spans")
    add = lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n"))
    batch = lambda i: spark.createDataFrame([(i % 3, 1), (7, i)], "k int, n long")
    for i in range(31):
        spans.write(batch(i), root, i, add)
        if i in (9, 10, 19):
            spans.write(batch(i), root, i, add)  # a replay
        assert len(spans.complete(spark, root)) <= 2 * spans.FAN
        assert sum(len(subfolders(spark, f"{root}/{f}")) for f in subfolders(spark, root)) <= 3 * spans.FAN
    got = rows_of(add(spans.read(spark, root, "k int, n long")))
    assert got == [(0, 11), (1, 10), (2, 10), (7, sum(range(31)))]
    assert len(spans.cover(9999)) == 1 and spans.cover(123, 10)[-1] == (123, 123) and len(spans.cover(123, 10)) == 16
    drop_folder(spark, f"{root}/_from=30")
    spans.write(batch(32), root, 32, add)
    with pytest.raises(ValueError):
        spans.read(spark, root, "k int, n long")


def test_restart_lands_nothing_twice(spark):
    root = new_dir(spark, "land")
    adapters.mixed(spark, SF).write.json(f"{root}/in")
    log = runner.ProgressLog()
    spark.streams.addListener(log)
    try:
        for _ in range(2):
            runner.drain(jobs.land(streams.read_files(spark, f"{root}/in"), f"{root}/out"), f"{root}/checkpoint")
        for _ in range(100):
            if sum(log.total_rows.values()) >= 1200:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert spark.read.schema("topic string, link string").json(f"{root}/out").count() == 1200
    assert sum(log.total_rows.values()) == 1200
    assert any(v.get("landed", {}).get("rows") for v in log.latest.values())


@pytest.mark.parametrize("remember", [None, 0, 3600])
def test_dedup_of_a_hot_article(spark, remember):
    """A third and more of the rows are copies of one article. A state that forgets at once gives the same."""
    root = new_dir(spark, "hot")
    n = spark.range(3000).select(
        F.when(F.col("id") < 2000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("link"),
        F.lit("t").alias("title"),
        F.lit("p").alias("published"),
        F.timestamp_seconds(F.col("id")).alias("event_time"),
    )
    schema = "link string, title string, published string, event_time timestamp"
    for part in (n.filter("id < 2500"), n.filter("id % 100 = 0"), n):
        part.repartition(4).write.mode("append").parquet(f"{root}/in")
        runner.drain(unique.dedup_news(spark.readStream.schema(schema).parquet(f"{root}/in"), f"{root}/out", remember=remember), f"{root}/checkpoint")
    got = spark.read.schema(schema).parquet(f"{root}/out/articles").collect()
    assert len(got) == len({r.link for r in got}) == 1001
    assert [r.event_time.timestamp() for r in got if r.link == "hot"] == [0.0]
    if remember == 0:
        assert spans.read(spark, f"{root}/out/archive", "_key string, _prefix string").count() > 0


def test_archived_dedup_input_is_not_written_by_one_task(spark, monkeypatch):
    sf, made = new_dir(spark, "tables"), []
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 300).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(8).alias("n_chars"))
    docs.repartition(4).write.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr(queries, "new_dir", lambda s, label: made.append(new_dir(s, label)) or made[-1])
    assert queries.stream_dedup_archived(spark, sf).select("link").distinct().count() == 300
    written = spark.read.parquet(made[0]).groupBy(F.col("_metadata.file_path")).count()
    assert written.agg(F.sum("count"), F.max("count") <= 150).first()[:] == (440, True)


def test_combiner_keeps_the_earliest(spark):
    rows = [("a", 5, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", None, "x"), ("b", 9, "w"), ("c", None, "q")]
    df = spark.createDataFrame(rows, "_key string, _time long, _digest string").coalesce(1)
    assert sorted(map(tuple, unique.earliest(df).collect()), key=repr) == [("a", 3, "y"), ("b", 9, "w"), ("c", None, "q")]


def test_late_copy_and_late_article(spark):
    root = new_dir(spark, "late-news")
    schema = "link string, title string, published string, event_time timestamp"
    for rows in ([("a", 100), ("b", 200)], [("a", 1), ("c", 2)], [("c", 300), ("d", 50)]):
        part = spark.createDataFrame(rows, "link string, t int").select("link", F.lit("t").alias("title"), F.lit("p").alias("published"), F.timestamp_seconds("t").alias("event_time"))
        part.write.mode("append").parquet(f"{root}/in")
        runner.drain(unique.dedup_news(spark.readStream.schema(schema).parquet(f"{root}/in"), f"{root}/out"), f"{root}/checkpoint")
    got = spark.read.schema(schema).parquet(f"{root}/out/articles").select("link", F.unix_timestamp("event_time").alias("t"))
    assert rows_of(got) == [("a", 100), ("b", 200), ("c", 2), ("d", 50)]


def test_landed_files_stay_few(spark):
    root = new_dir(spark, "grouped")
    rows = adapters.mixed(spark, SF)
    for i in range(22):
        rows.filter(F.pmod(F.hash("message_id", "link"), F.lit(22)) == i).coalesce(1).write.mode("append").json(f"{root}/in")
    stream = streams.read_files(spark, f"{root}/in", files_per_trigger=1)
    runner.drain(jobs.land_grouped(stream, f"{root}/out"), f"{root}/checkpoint")
    back = files.read_landed(spark, f"{root}/out")
    assert back.drop("_topic", "_date").exceptAll(rows).isEmpty() and back.count() == rows.count()
    layouts = back.select("_topic", "_date").distinct().count()
    n_files = len(back.inputFiles())
    assert n_files <= 4 * layouts  # two spans of ten batches and two of one; each batch alone would have a file a layout
    assert back.filter("_topic = 'news' and _date = '2024-01-05'").select("_date").distinct().count() == 1


def test_fan_out_views_follow_the_stream(spark):
    root = new_dir(spark, "fan")
    prices, news = SnapshotTable(spark, f"{root}/p"), SnapshotTable(spark, f"{root}/n")
    mixed = adapters.mixed(spark, SF)
    half = F.lit("2024-01-16T00:00:00")
    for part in (mixed.filter(F.coalesce(F.col("ts_iso") < half, F.lit(True))), mixed.filter(F.col("ts_iso") >= half)):
        part.write.mode("append").json(f"{root}/in")
        stream = streams.read_files(spark, f"{root}/in")
        runner.drain(jobs.fan_out(stream, prices, news, f"{root}/feed"), f"{root}/checkpoint")
    want = adapters.ticks(spark, SF).orderBy(F.desc("event_time")).limit(10)
    assert {r.message_id for r in prices.read().collect()} == {r.message_id for r in want.collect()}
    assert news.read().count() == 10
    assert spark.read.schema("type string").json(f"{root}/feed").count() == 1200


def test_running_query_is_drained_on_stop(spark):
    root = new_dir(spark, "stop")
    adapters.mixed(spark, SF).write.json(f"{root}/in")
    job = jobs.land(streams.read_files(spark, f"{root}/in"), f"{root}/out")
    query = runner.start(job, f"{root}/checkpoint", every="1 second")
    runner.stop_all(spark)
    assert not query.isActive
    assert spark.read.schema("topic string, link string").json(f"{root}/out").count() == 1200


def test_trend_over_batches_equals_batch(spark):
    """The later rows come first; late hours, NaN and infinite prices are handled; many batches are read from few folders."""
    root = new_dir(spark, "trend")
    ticks = adapters.ticks(spark, SF).select("message_id", "commodity", "price", "event_time")
    odd = ticks.limit(2).withColumn("price", F.lit(float("nan"))).union(ticks.limit(2).withColumn("price", F.lit(float("inf"))))
    for a, b in (("2024-01-10", "2024-02-01"), ("2024-01-01", "2024-01-10")):
        part = ticks.filter((F.col("event_time") >= F.lit(a)) & (F.col("event_time") < F.lit(b)))
        part.union(odd).repartition(7).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        runner.drain(hours.partial_sums(stream, f"{root}/out"), f"{root}/checkpoint")
    want = ticks.groupBy("commodity", F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("h")).agg(F.count("price").alias("n"), F.round(F.max("price"), 0))
    assert rows_of(hours.totals(spark, f"{root}/out").select("commodity", "hour_start", "n_obs", "max_price")) == rows_of(want)
    assert spans.complete(spark, f"{root}/out")[0] == (0, 9)


def test_closed_hours_come_out_once(spark):
    root = new_dir(spark, "hours")
    for rows in (
        [("a", "x", 10.0, "2024-01-01 01:10:00"), ("b", "x", 20.0, "2024-01-01 05:00:00")],
        [("c", "x", 30.0, "2024-01-01 01:20:00"), ("d", "x", 5.0, "2024-01-01 02:20:00"), ("e", "x", 20.0, "2024-01-01 05:30:00")],
        [("f", "x", 20.0, "2024-01-01 06:59:00")],
    ):
        observations(spark, rows).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        runner.drain(hours.partial_sums(stream, f"{root}/sums"), f"{root}/checkpoint/sums")
        runner.drain(hours.closed_hours(stream, f"{root}/closed", "30 minutes"), f"{root}/checkpoint/closed")
    closed = spark.read.schema(hours.HOURS).parquet(f"{root}/closed")
    assert [(r.hour_start.hour, r.n_obs) for r in closed.orderBy("hour_start").collect()] == [(1, 1), (5, 2)]
    now = hours.standing(spark, f"{root}/sums", f"{root}/closed").orderBy("hour_start").collect()
    assert [(r.hour_start.hour, r.n_obs, r.avg_price, r.state) for r in now] == [(1, 2, 20.0, "corrected"), (2, 1, 5.0, "late"), (5, 2, 20.0, "closed"), (6, 1, 20.0, "open")]


def test_validation_counts_are_observed(spark):
    root = new_dir(spark, "valid")
    rows = [("beras", "5000", "kg"), ("beras", "0", "kg"), ("kopi", "5", "kg")]
    spark.createDataFrame(rows, "commodity string, price string, unit string").coalesce(1).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("commodity string, price string, unit string").parquet(f"{root}/in")
    writer = jobs.validated(stream, ["beras"]).writeStream.format("parquet").option("path", f"{root}/out")
    query = runner.start(writer, f"{root}/checkpoint", every=None)
    query.awaitTermination()
    seen = [p.observedMetrics["validation"] for p in query.recentProgress if "validation" in p.observedMetrics]
    assert (sum(r.sent for r in seen), sum(r.dropped for r in seen)) == (1, 2)
    assert spark.read.parquet(f"{root}/out").count() == 1
