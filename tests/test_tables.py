"""Readers, versioned tables, live views, documents and messages."""

import json
import os

import pytest
from pyspark.sql import functions as F

from settings import SF
from pricewatch import schemas, session
from pricewatch.operators import clean, enrich
from pricewatch.plans import lakehouse, queries
from pricewatch.session import drop_folder, new_dir, shared_dir
from pricewatch.sinks import documents, live, publish
from pricewatch.sources import adapters, files, streams
from pricewatch.sources.snapshots import SnapshotTable, compare


def write(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(body if isinstance(body, str) else json.dumps(body, ensure_ascii=False))


def test_silver_deals_the_raw_rows_out(spark, monkeypatch):
    """One small file of narrow rows, one key: no task sorts all of them."""
    house = lakehouse.Lakehouse(spark, new_dir(spark, "house"), queries.SETTINGS)
    rows = schemas.to_mixed(spark.range(4000).select(F.lit("m").alias("message_id"), F.lit("view").alias("commodity"), F.col("id").cast("double").alias("price"), F.lit("prices").alias("topic")))
    for name in ("prices", "news"):
        house.bronze(name, rows.coalesce(1), "feed")
    seen, tagged = [], clean.tagged_prices
    monkeypatch.setattr(clean, "tagged_prices", lambda df, settings: seen.append(df) or tagged(df, settings))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        house.silver()
        each = seen[0].groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert each[0] == 4000 and each[1] < 1000
    assert house.table("silver", "prices").read().count() == 1


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_local_folders_are_refused_on_a_cluster():
    assert session.on_one_machine("local[8]") and session.on_one_machine("local") and not session.on_one_machine("local-cluster[2,1,1024]")
    assert session.is_local("file:/tmp/w") and not session.is_local("hdfs://n/w") and not session.is_local("s3a://b/w")


def test_wire_files_with_a_broken_one(spark, tmp_path):
    price = {"komoditas": "beras", "harga": 14500.5, "jam": "08:00:00", "topic": "p", "message_id": "x"}
    news = {"title": "é", "timestamp": "2026-03-06 08:00:00", "komoditas": "umum", "topic": "n"}
    write(f"{tmp_path}/in/a.json", [price, price])
    write(f"{tmp_path}/in/b.json", [news])
    write(f"{tmp_path}/in/c.json", "[]")
    write(f"{tmp_path}/in/d.json", '[{"komoditas": "beras", ')
    df = files.read_messages(spark, f"{tmp_path}/in", wire=True).cache()
    assert df.count() == 4 and df.filter(F.col(files.CORRUPT).isNotNull()).count() == 1
    good = files.well_formed(df)
    assert good.columns == schemas.MIXED_COLUMNS
    assert sorted((r.commodity, r.price, r.obs_time, r.ts_text) for r in good.collect() if r.price) == [("beras", 14500.5, "08:00:00", None)] * 2
    assert [r.title for r in good.collect() if r.title] == ["é"]


@pytest.mark.parametrize(
    "body, rows, status",
    [
        ([{"k": "a", "v": 1.0}], [("a", 1.0)], "local"),
        ({"topic": "t", "timestamp": "x", "count": 7, "data": [{"k": "a", "v": 1.0}, {"k": "b"}]}, [("a", 1.0), ("b", None)], "local"),
        ({"topic": "t", "count": 0, "data": []}, [], "empty"),
        ("[]", [], "empty"),
        ("{oops", [], "failed"),
        (None, [], "failed"),
    ],
)
def test_live_layouts(spark, tmp_path, body, rows, status):
    path = f"{tmp_path}/view/live.json"
    if body is not None:
        write(path, body)
    df, got = files.read_live(spark, path, "k string, v double")
    assert (sorted(tuple(r) for r in df.collect()), got) == (rows, status)


def test_snapshots(spark):
    table = SnapshotTable(spark, new_dir(spark, "t"))
    with pytest.raises(ValueError):
        table.read()
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, name string")
    assert table.overwrite(rows, "CREATE") == 0
    assert table.append(rows.filter("id = 1").withColumn("extra", F.lit(1.5))) == 1
    assert table.update(F.col("name") == "c", {"name": F.lit("z")}) == 2
    assert table.delete(F.col("name") == "a") == 3
    view = lambda v: sorted(tuple(r) for r in table.read(v).select("id", F.coalesce("name", F.lit("-"))).collect())
    assert view(0) == [(1, "a"), (2, "-"), (3, "c")]
    assert view(1) == [(1, "a"), (1, "a"), (2, "-"), (3, "c")]
    assert view(2) == [(1, "a"), (1, "a"), (2, "-"), (3, "z")]
    assert view(3) == [(2, "-"), (3, "z")] == view(None)
    assert table.read().columns == ["id", "name", "extra"]
    log = [tuple(r) for r in table.history(F.count_if(F.col("name").isNull()), F.max("id")).orderBy("version").collect()]
    assert log == [(0, "CREATE", "overwrite", 3, 1, 3), (1, "APPEND", "append", 1, 0, 1), (2, "UPDATE", "overwrite", 4, 1, 3), (3, "DELETE", "overwrite", 2, 1, 3)]
    assert table.versions() == [0, 1, 2, 3]
    table.vacuum(1)
    assert table.versions() == [3] and view(None) == [(2, "-"), (3, "z")]
    with pytest.raises(ValueError):
        table.read(9)


def test_partitioned_snapshots(spark, capsys):
    table = SnapshotTable(spark, new_dir(spark, "t"), partition_by=("obs_date",))
    df = adapters.ticks(spark, SF).select(F.to_date("event_time").alias("obs_date"), "message_id", "price")
    table.overwrite(df)
    got = table.read()
    assert sorted(got.dtypes) == sorted(df.dtypes) and got.columns[-1] == "obs_date"
    assert got.select(*df.columns).exceptAll(df).isEmpty() and got.count() == df.count()
    got.filter("obs_date = '2024-01-05'").explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) == 1 and "= 2024-01-05" in filters[0]


def test_uncommitted_write_is_invisible(spark):
    table = SnapshotTable(spark, new_dir(spark, "t"))
    rows = spark.range(3)
    table.append(rows)
    unfinished = f"{table.path}/_base=0/_from=1/_to=1"
    spark.range(99).write.parquet(unfinished)
    drop_folder(spark, f"{unfinished}/_SUCCESS")
    assert table.read().count() == 3
    assert table.append(rows) == 1
    assert table.read().count() == 6


def test_other_versions_are_not_read(spark):
    table = SnapshotTable(spark, new_dir(spark, "t"))
    for _ in range(3):
        table.overwrite(spark.range(10))
    files_read = table.read(1).inputFiles()
    assert files_read and all("_base=1/" in f for f in files_read)


def test_many_appends_are_read_from_few_folders(spark):
    table = SnapshotTable(spark, new_dir(spark, "t"))
    for i in range(12):
        table.append(spark.createDataFrame([(i,)], "id int").withColumn("extra" if i > 5 else "id", F.lit(i)))
    assert sorted(r.id for r in table.read().collect()) == list(range(12)) and table.read().columns == ["id", "extra"]
    assert sorted(r.id for r in table.read(4).collect()) == list(range(5))
    assert len({f.split("/_to=")[0] for f in table.read().inputFiles()}) == 3
    assert table.history().count() == 12 and table.done(11) and not table.done(12)


def test_compare(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    after = spark.createDataFrame([(2, "b"), (3, "c"), (4, "d")], "k int, v string")
    got = {tuple(r) for r in compare(before, after, ["k"], ["v"]).collect()}
    assert got == {(1, "removed", "a", None), (3, "changed", None, "c"), (4, "added", None, "d")}


def test_live_refresh_keeps_newest_and_skips_replays(spark):
    view = SnapshotTable(spark, new_dir(spark, "view"))
    batch = lambda ids: spark.createDataFrame([(f"{i:03d}",) for i in ids], "message_id string").withColumn(
        "arrived", F.timestamp_add("MINUTE", F.col("message_id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    )
    live.refresh(view, batch(range(8)), ["message_id"], 5, batch_id=0)
    live.refresh(view, batch(range(8, 11)), ["message_id"], 5, batch_id=1)
    live.refresh(view, batch(range(50, 60)), ["message_id"], 5, batch_id=1)
    assert sorted(r.message_id for r in view.read().collect()) == ["006", "007", "008", "009", "010"]


def test_results_document(spark):
    doc = json.loads(queries.results_document(spark, SF).first().document)
    assert doc["metadata"] == {"generated_at": "2024-02-01T00:00:00", "total_prices": 1000, "total_news": 200}
    sections = doc["analyses"]
    assert list(sections) == ["volatility", "price_trend", "news_correlation"]
    index = [r["range_index"] for r in sections["volatility"]]
    assert len(index) == 5 and index == sorted(index, reverse=True)


def test_dashboard_payload(spark):
    doc = json.loads(queries.dashboard_payload(spark, SF).first().document)
    assert len(doc["live_prices"]) == 20 and len(doc["news"]) == 20
    assert doc["status"] == {"analyses_ok": True, "live_ok": True, "news_ok": True}
    assert doc["live_prices"][0]["ts_iso"] == max(r["ts_iso"] for r in doc["live_prices"])
    assert all(len(r["summary"]) <= 300 for r in doc["news"])


def test_export_document(spark):
    doc = json.loads(queries.export_document(spark, SF).first().document)
    assert doc.pop("metadata") == {"generated_at": "2024-02-01T00:00:00", "source": "gold", "pipeline": "price-monitor"}
    assert {k: len(v) <= documents.EXPORT_LIMITS[k] for k, v in doc.items()} == dict.fromkeys(documents.EXPORT_LIMITS, True)
    assert doc["alert"][0]["event_time"].endswith("T00:00:00.000000")


def test_section_of_many_commodities(spark):
    rows = spark.range(10_001).select(F.format_string("c%05d", "id").alias("commodity"))
    doc = documents.as_json(documents.document({"all": documents.rows_as_array(rows, [F.desc("commodity")])}))
    got = json.loads(doc.first().document)["all"]
    assert len(got) == 10_001 and got[0]["commodity"] == "c10000"


def test_landing_keeps_the_topic(spark):
    from pricewatch.sinks import files as file_sink

    path = new_dir(spark, "landed")
    rows = adapters.mixed(spark, SF)
    file_sink.land(rows, path)
    back = files.well_formed(files.read_messages(spark, path, multi_line=False))
    assert back.columns == schemas.MIXED_COLUMNS
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    assert clean.price_accounting(back, queries.SETTINGS).filter("step = 1").first().n_before == rows.count()


def test_document_written_as_one_text(spark):
    path = new_dir(spark, "doc")
    documents.write_document(documents.as_json(spark.range(1)), path)
    assert spark.read.text(path).count() == 1


def test_lakehouse(spark):
    house = lakehouse.Lakehouse(spark, new_dir(spark, "house"), queries.SETTINGS)
    rows = adapters.mixed(spark, SF)
    house.bronze("prices", rows, "mixed")
    house.bronze("news", rows.filter("topic = 'news'"), "news")
    house.silver()
    house.gold()
    silver, bronze = house.cleaned("prices"), house.table("bronze", "prices").read()
    assert bronze.columns == schemas.BRONZE_COLUMNS
    assert 0 < silver.count() <= bronze.count()
    steps = house.accounting().filter("table_name = 'prices'").agg(F.sum("n_removed")).first()[0]
    assert bronze.count() - silver.count() == steps
    direct = clean.price_accounting(bronze, queries.SETTINGS)
    assert direct.exceptAll(house.accounting().filter("table_name = 'prices'")).isEmpty()
    assert silver.select("message_id", "price", "event_time").exceptAll(
        clean.clean_prices(bronze, queries.SETTINGS).select("message_id", "price", "event_time")
    ).isEmpty()
    gold = house.table("gold", "volatility")
    before = gold.latest_version()
    house.review_critical()
    changed = gold.diff(before, before + 1, ["commodity"], ["status"])
    n_critical = gold.read(before).filter("status = 'CRITICAL'").count()
    assert changed.count() == n_critical > 0
    doc = json.loads(house.export().first().document)
    assert list(doc) == ["metadata", *documents.EXPORT_LIMITS]


def test_envelopes(spark):
    now = F.lit("2026-03-06 08:00:00.000001").cast("timestamp_ntz")
    df = spark.createDataFrame([("beras", 14500.0)], "commodity string, price double")
    row = enrich.price_envelope(df, now).first()
    import hashlib

    assert row.message_id == hashlib.md5(b"beras2026-03-06T08:00:00.000001").hexdigest()[:12]
    assert (row.unit, row.region, row.source_name, row.is_shock, row.ts_unix) == ("kg", "Nasional", "unknown", False, 1772784000)
    entry = spark.createDataFrame(
        [(" T ", None, "<p>" + "x" * 600 + " gabah</p>", None, "upd", "f")],
        "title string, link string, summary string, published string, updated string, source_feed string",
    )
    news = enrich.news_envelope(entry, now).first()
    assert (news.title, news.link, len(news.summary), news.published, news.commodity) == ("T", "", 500, "upd", "beras")
    keyed = publish.keyed_news(enrich.news_envelope(entry, now)).first()
    digest = hashlib.md5(b"Tupd").hexdigest()
    assert keyed.key == hashlib.md5(digest.encode()).hexdigest()


def test_kafka_options():
    assert streams.kafka_options("h:1", ["a"]) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a", "startingOffsets": "earliest", "failOnDataLoss": "true",
    }
    many = streams.kafka_options("h:1", ["a", "b"], "latest", 100)
    assert (many["subscribe"], many["startingOffsets"], many["maxOffsetsPerTrigger"]) == ("a,b", "latest", "100")
    out = publish.kafka_options("h:1", "a")
    assert (out["kafka.acks"], out["kafka.compression.type"]) == ("all", "gzip")


def test_decode_messages(spark):
    raw = spark.createDataFrame([(b'{"komoditas":"beras","harga":5.5}',), (b"nope",)], "value binary")
    got = streams.decode(raw).collect()
    assert [(r.commodity, r.price) for r in got if r.commodity] == [("beras", 5.5)]
