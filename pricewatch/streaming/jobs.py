"""The streaming jobs without state of their own. Every output is tied to the checkpoint or to the batch id, so a restart or a
replayed batch adds nothing twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pricewatch.operators import clean
from pricewatch.operators.enrich import add_provenance
from pricewatch.sinks import live
from pricewatch.sources.snapshots import SnapshotTable
from pricewatch.streaming import spans


def land(stream: DataFrame, path: str) -> DataStreamWriter:
    """Messages as JSON files in one folder per topic, with counters for the progress log."""
    counted = stream.observe(
        "landed",
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("topic").isNull()).alias("without_topic"),
    )
    return counted.withColumn("_topic", F.col("topic")).writeStream.format("json").option("path", path).partitionBy("_topic")


LAYOUT = ("_topic", "_date")


def land_grouped(stream: DataFrame, path: str) -> DataStreamWriter:
    """Messages as JSON in one folder per topic and day, regrouped as they pile up.

    Ten spans of batches become one wider span, in which Spark deals the rows of a topic and day out to files of its advisory size, however small
    the files of the batches were. Readers (:func:`pricewatch.sources.files.read_landed`) see each row once at any time.
    """
    day = F.substring(F.coalesce("ts_iso", "ts_text"), 1, 10)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"_topic": F.col("topic"), "_date": day})
        spans.write(rows, path, batch_id, lambda parts: parts.hint("rebalance", *LAYOUT), LAYOUT, spans.FAN**4, "json")

    return stream.writeStream.foreachBatch(write)


def validated(stream: DataFrame, known: list[str], raw_price: str = "price") -> DataFrame:
    """Valid price records of a stream or table; sent and dropped rows are counted as ``validation``."""
    tagged = clean.validate_prices(stream, known, raw_price)
    bad = F.col("reject_reason").isNotNull()
    counted = tagged.observe("validation", F.count_if(~bad).alias("sent"), F.count_if(bad).alias("dropped"))
    return counted.filter(~bad).drop("reject_reason")


def ingest(stream: DataFrame, table: SnapshotTable, source: str) -> DataStreamWriter:
    """Append every batch of landed files to the raw table, which is the job's own, as the version of the batch's id, with its provenance."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not table.done(batch_id):
            table.append(add_provenance(batch, source), "STREAMING APPEND", batch_id)

    return stream.writeStream.foreachBatch(write)


def fan_out(
    stream: DataFrame,
    price_view: SnapshotTable,
    news_view: SnapshotTable,
    feed_path: str,
    n: int = 10,
    price_topic: str = "prices",
    news_topic: str = "news",
) -> DataStreamWriter:
    """One read of the stream, three outputs: newest prices, newest news, the combined feed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            feed = live.tagged_feed(batch, price_topic, news_topic)
            feed.write.mode("overwrite").json(f"{feed_path}/batch={batch_id}")
            live.refresh(price_view, live.live_prices(batch, price_topic), ["message_id"], n, batch_id)
            live.refresh(news_view, live.live_news(batch, news_topic), ["link", "title"], n, batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write)
