"""Live views: the newest rows of each topic in the layout a page reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.functions import times
from pricewatch.operators.slices import newest_per_key
from pricewatch.sources.snapshots import SnapshotTable

LIVE_ROWS = 200
SUMMARY_CHARS = 300  # displayed length of a summary, in the view only


def _arrival() -> Column:
    return times.resolve_event_time(F.col("ts_text"), F.col("ts_iso"), F.col("obs_date"), F.col("obs_time"))


def _or(name: str, default: object) -> Column:
    return F.coalesce(F.col(name), F.lit(default)).alias(name)


def live_prices(messages: DataFrame, topic: str = "prices", now: Column | None = None) -> DataFrame:
    """The eleven fields shown for a price, with defaults, and ``arrived`` to order by."""
    now_text = times.iso_text(now if now is not None else F.current_timestamp().cast("timestamp_ntz"))
    return messages.filter(F.col("topic") == topic).select(
        _or("commodity", ""),
        _or("label", ""),
        _or("price", 0.0),
        _or("unit", "kg"),
        _or("region", "Nasional"),
        "ref_price",
        "ref_change_pct",
        _or("source_name", "simulator"),
        _or("obs_date", ""),
        _or("obs_time", ""),
        F.coalesce("ts_iso", now_text).alias("ts_iso"),
        F.coalesce("message_id", F.lit("")).alias("message_id"),
        _arrival().alias("arrived"),
    )


def live_news(
    messages: DataFrame,
    topic: str = "news",
    general: str = "umum",
    now: Column | None = None,
    summary_chars: int | None = SUMMARY_CHARS,
) -> DataFrame:
    """The seven fields shown for an article, with defaults, and ``arrived`` to order by.

    ``summary_chars`` is the display format's limit; None shows whole summaries.
    """
    summary = F.coalesce("summary", F.lit(""))
    now_text = F.date_format(now if now is not None else F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return messages.filter(F.col("topic") == topic).select(
        _or("title", ""),
        _or("link", "#"),
        (summary if summary_chars is None else F.substring(summary, 1, summary_chars)).alias("summary"),
        _or("commodity", general),
        F.coalesce("ts_text", now_text).alias("ts_text"),
        _or("published", ""),
        _or("source_feed", ""),
        _arrival().alias("arrived"),
    )


def newest(messages: DataFrame, n: int, ties: list[str], by: str = "topic", arrived: Column | None = None) -> DataFrame:
    """Newest ``n`` messages of each topic with their rank; equal times ordered by ``ties``."""
    order = (arrived if arrived is not None else _arrival()).desc_nulls_last()
    return newest_per_key(messages, [by], [order, *[F.col(c).asc_nulls_last() for c in ties]], n)


def refresh(view: SnapshotTable, batch: DataFrame, ties: list[str], n: int = LIVE_ROWS, batch_id: int | None = None, keep: int = 3) -> int:
    """Merge a batch into a live view and keep the newest ``n`` rows. Versions are named by the batch; a replayed one is skipped. The
    files of all but the ``keep`` newest versions go."""
    if batch_id is not None and view.done(batch_id):
        return view.latest_version()
    rows = batch
    if not view.empty():
        rows = view.read().unionByName(batch)
    top = rows.orderBy(F.col("arrived").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]).limit(n)
    version = view.overwrite(top, "REFRESH", batch_id)
    view.vacuum(keep)
    return version


def tagged_feed(messages: DataFrame, price_topic: str = "prices", news_topic: str = "news") -> DataFrame:
    """Both topics as one feed of (type, payload, arrived)."""
    kind = F.when(F.col("topic") == price_topic, "price").when(F.col("topic") == news_topic, "news")
    return messages.select(
        kind.alias("type"), F.to_json(F.struct("*")).alias("data"), _arrival().alias("arrived")
    ).filter(F.col("type").isNotNull())


def envelope(rows: DataFrame, topic: str, at: Column, order_by: list[Column], n: int = 10) -> DataFrame:
    """One row ``{topic, timestamp, count, data}`` with the newest ``n`` rows in ``data``."""
    from pricewatch.sinks.documents import rows_as_array

    count = rows.agg(F.count(F.lit(1)).alias("count"))
    data = rows_as_array(rows, order_by, n).select(F.col("rows").alias("data"))
    return (
        count.unionByName(data, allowMissingColumns=True)
        .agg(F.max("count").alias("count"), F.first("data", ignorenulls=True).alias("data"))
        .select(F.lit(topic).alias("topic"), at.alias("timestamp"), "count", "data")
    )
