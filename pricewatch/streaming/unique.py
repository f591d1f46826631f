"""Each article once, from a stream with copies at any distance.

Three steps, so that neither a hot article nor the number of articles so far weighs on a batch:

* tasks keep the earliest of the copies in each Arrow batch, before the shuffle;
* keyed state, one entry per article in RocksDB, knows the articles seen: a batch looks up its own articles only;
* with ``remember``, an entry leaves the state by a timer that long after the article first came (the watermark is on the time of
  arrival, so no row is ever late), and moves to an archive of keys in
  Parquet, partitioned by the first digits of their digest. Only articles the state does not know are looked up there, in
  the partitions of their digits only. Without it, entries stay in the state for good and there is no archive.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor

from pricewatch.functions import text
from pricewatch.session import keyed_state
from pricewatch.streaming import spans

#: Hexadecimal digits of the digest that name an archive partition: at most 256 of them.
DIGITS = 2
_ARCHIVE = "_key string, _prefix string"


def earliest(rows: DataFrame) -> DataFrame:
    """The earliest copy of each article of every Arrow batch: a combiner that needs no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch, [("_key", "ascending"), ("_time", "ascending"), ("_digest", "ascending")]))
            if batch.num_rows:
                key = batch.column("_key")
                batch = batch.filter(pa.concat_arrays([pa.array([True]), pc.not_equal(key[1:], key[:-1])]))
            yield batch

    return rows.mapInArrow(run, rows.schema)


class FirstSeen(StatefulProcessor):
    """State of one article: whether it has come."""

    def __init__(self, columns: list[str], remember: int | None):
        self.columns, self.remember = columns, remember

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "known boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = None
        for row in rows:
            rank = (row["_time"] is None, row["_time"] or 0, row["_digest"])
            if best is None or rank < best[0]:
                best = rank, row
        if best is not None and not self.seen.exists():
            self.seen.update((True,))
            if self.remember is not None:
                self.handle.registerTimer(best[1]["_arrived_ms"] + self.remember)
            yield Row(**{c: best[1][c] for c in self.columns}, _key=key[0], _old=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        yield Row(**dict.fromkeys(self.columns), _key=key[0], _old=True)

    def close(self) -> None:
        pass


def dedup_news(stream: DataFrame, path: str, time_column: str = "event_time", remember: float | None = None) -> DataStreamWriter:
    """Each article once, however late a copy comes: parquet folders ``batch=N`` under ``path/articles``.

    A batch keeps the earliest copy of an article, ties by the digest of the row. ``remember``: seconds that an article's key stays in the state.
    """
    keyed_state(stream.sparkSession)
    columns = stream.columns
    rows = stream.select(
        *(F.col(f"`{c}`") for c in columns),
        F.md5(text.article_id(F.col("link"), F.col("title"), F.col("published"))).alias("_key"),
        F.unix_micros(F.col(f"`{time_column}`").cast("timestamp")).alias("_time"),
        F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns)))).alias("_digest"),
    )
    schema = T.StructType([*stream.schema.fields, T.StructField("_key", T.StringType()), T.StructField("_old", T.BooleanType())])
    kept = None if remember is None else int(remember * 1000)
    rows = earliest(rows)
    if kept is not None:
        rows = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", "0 seconds").withColumn("_arrived_ms", F.unix_millis("_arrived"))
    first = rows.groupBy("_key").transformWithState(FirstSeen(columns, kept), schema, "append", "none" if kept is None else "eventTime")

    def write(batch: DataFrame, batch_id: int) -> None:
        if kept is None:
            batch.select(*columns).write.mode("overwrite").parquet(f"{path}/articles/batch={batch_id}")
            return
        batch = batch.withColumn("_prefix", F.substring("_key", 1, DIGITS)).persist()
        try:
            new = batch.filter("not _old")
            touched = [r[0] for r in new.select("_prefix").distinct().collect()]
            known = spans.read(batch.sparkSession, f"{path}/archive", _ARCHIVE).filter(F.col("_prefix").isin(touched)).select("_key")
            new.join(known, "_key", "left_anti").select(*columns).write.mode("overwrite").parquet(f"{path}/articles/batch={batch_id}")
            # Keys of this batch's timers come after the look-up: their copies, if any, were still known to the state.
            spans.write(batch.filter("_old").select("_key", "_prefix"), f"{path}/archive", batch_id, DataFrame.distinct, ("_prefix",))
        finally:
            batch.unpersist()

    return first.writeStream.foreachBatch(write)
