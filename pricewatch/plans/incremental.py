"""Cleaning of new raw rows only.

A cleaned table keeps one row per key, laid out by date. A batch of raw rows touches the dates of its own rows, and those where an older row of one of
its keys stands; only these partitions are read and rewritten. Where a key's row stands is known from a small table of keys, laid out by
buckets of their digests, of which a batch reads and rewrites its own buckets. After any sequence of batches the table equals one made from all raw
rows at once: the order that decides which row of a key stays is total and looks at nothing but the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch.functions import text
from pricewatch.operators import clean
from pricewatch.session import stored
from pricewatch.sources.partitioned import PartitionedTable

BUCKETS = 256
_KEYS = "_digest string, _date date, _bucket int"


@dataclass(frozen=True)
class Cleaning:
    """What a table keeps: its key, its duplicate rule and its row rules."""

    key: list[str]
    dedup: Callable[[DataFrame], DataFrame]
    rules: Callable[[clean.Settings], list[tuple[str, Column]]]


PRICES = Cleaning(clean.PRICE_KEY, clean.dedup_prices, clean.price_rules)
NEWS = Cleaning(clean.NEWS_KEY, clean.dedup_news, clean.news_rules)


class IncrementalClean:
    """A cleaned table below ``path`` for raw rows of ``schema``. Raw columns stay as they came, the final ones are added."""

    def __init__(self, spark: SparkSession, path: str, schema: str, cleaning: Cleaning, settings: clean.Settings, buckets: int = BUCKETS):
        """``buckets``: partitions of the table of keys, 256 at most; the same number for the table's life."""
        self.spark, self.cleaning, self.settings, self.buckets = spark, cleaning, settings, buckets
        self.raw = spark.createDataFrame([], schema).schema
        self.rows = PartitionedTable(spark, f"{path}/rows", self._finished(spark.createDataFrame([], schema)).schema, ("_date",))
        self.keys = PartitionedTable(spark, f"{path}/keys", _KEYS, ("_bucket",))

    def _finished(self, rows: DataFrame) -> DataFrame:
        at = clean.event_time(self.settings)
        tagged = clean.tag(rows, self.cleaning.rules(self.settings)).withColumn("event_time", at)
        return tagged.withColumns({"hour": F.hour("event_time"), "dow": F.dayofweek("event_time"), "_date": F.to_date("event_time")})

    def _keyed(self, rows: DataFrame) -> DataFrame:
        digest = F.md5(F.to_json(F.struct(*self.cleaning.key), {"ignoreNullFields": "false"}))
        return rows.withColumn("_digest", digest).withColumn("_bucket", F.conv(F.substring("_digest", 1, 2), 16, 10).cast("int") % self.buckets)

    def add(self, batch: DataFrame) -> None:
        """Merge a batch of raw rows. A repeated batch changes nothing.

        The batch is read twice, for its keys and dates and for its rows, and has to give the same rows; write one first that may not.
        """
        batch = batch.select(*self.raw.names)
        keyed = stored(self._keyed(self._finished(batch)).select("_digest", "_date", "_bucket").distinct(), "new-keys")
        buckets, own = keyed.select("_bucket").distinct(), keyed.select("_digest").distinct()
        known = stored(self.keys.in_partitions(buckets), "known-keys")
        old = known.join(own, "_digest", "left_semi")
        touched = stored(keyed.select("_date").union(old.select("_date")).distinct(), "touched-dates")
        # One row of each key among the old rows of the touched dates and the new ones.
        both = self.rows.in_partitions(touched).select(*self.raw.names).unionByName(batch)
        self.rows.replace(self._finished(self.cleaning.dedup(both)), touched)
        moved = self._keyed(self.rows.in_partitions(touched)).select("_digest", "_date", "_bucket").join(own, "_digest", "left_semi")
        kept = known.join(own, "_digest", "left_anti")
        self.keys.replace(kept.unionByName(moved), buckets)

    def tagged(self) -> DataFrame:
        """All kept rows in final form, each with its reject reason."""
        return self.rows.read().withColumn("commodity", text.normal_key("commodity"))

    def cleaned(self) -> DataFrame:
        return clean.accepted(self.tagged())
