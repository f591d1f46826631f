"""Early warnings on a stream whose rows come in any order.

A price is compared with the observation before it, so a late row has an alert of its own, and the row after it a corrected one. Two jobs
keep what is needed in keyed state:

* :func:`changes` keeps the observations of each commodity and period (a day unless told otherwise), so that a hot commodity is spread over its
  periods. New rows are put in their places; every row whose predecessor is new comes out with it. A period's first and last observation
  are its edges; they come out when they change.
* :func:`edge_changes` keeps the edges of each commodity's periods, two observations a period, and does the same across periods.

Each result carries a revision; :func:`current` takes the newest of each observation. A result that corrects an earlier one
comes out even if the change is no longer significant, which takes an alert back.

Without a horizon no row is ever too late, and the state grows with the observations (in RocksDB, on disk). With one, a period's
observations leave the state by an event-time timer once the watermark has passed its end; Spark drops rows older than that and counts them in the
progress as rows dropped by the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor

from pricewatch import dims
from pricewatch.operators.alerts import ALERT_COLUMNS, classify_changes
from pricewatch.operators.clean import priced
from pricewatch.session import keyed_state
from pricewatch.streaming import spans

DAY = 86_400
_OBSERVED = "times array<long>, ids array<string>, prices array<double>, revision long"
_EDGES = "first_time long, first_id string, first_price double, last_time long, last_id string, last_price double"
_CHANGE = "commodity string, at long, message_id string, price double, prev_price double, across boolean, revision long, correction boolean"
_OUT = f"{_CHANGE}, period long, {_EDGES}"
_EDGE_STATE = "periods array<long>, first_time array<long>, first_id array<string>, first_price array<double>, last_time array<long>, last_id array<string>, last_price array<double>, revision long"


def _frame(rows: list[dict] | pd.DataFrame, columns: str) -> pd.DataFrame:
    """The named columns; text as plain objects, which Arrow takes as one array."""
    names = [c.split()[0] for c in columns.split(", ")]
    out = rows.reindex(columns=names) if isinstance(rows, pd.DataFrame) else pd.DataFrame(rows, columns=names)
    return out.astype({c.split()[0]: object for c in columns.split(", ") if c.endswith(" string")})


class PeriodObservations(StatefulProcessor):
    """State of one commodity and period: its observations in order."""

    def __init__(self, width: int, horizon: bool):
        self.width, self.horizon = width, horizon

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("observed", _OBSERVED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        times, ids, prices, revision = self.state.get() if self.state.exists() else ([], [], [], 0)
        all_rows = pd.DataFrame(
            {
                "at": np.r_[np.array(times, dtype=np.int64), new["at"].to_numpy(dtype=np.int64)],
                "message_id": [*ids, *new["message_id"]],
                "price": np.r_[np.array(prices, dtype=np.float64), new["price"].to_numpy(dtype=np.float64)],
                "new": np.r_[np.zeros(len(times), dtype=bool), np.ones(len(new), dtype=bool)],
            }
        ).sort_values(["at", "message_id"], kind="stable", ignore_index=True)
        self.state.update((all_rows["at"].tolist(), all_rows["message_id"].tolist(), all_rows["price"].tolist(), int(revision) + 1))
        if self.horizon:
            self.handle.registerTimer((int(key[1]) + 1) * self.width * 1000)
        fresh = all_rows["new"].to_numpy()
        touched = np.flatnonzero(fresh[1:] | fresh[:-1]) + 1
        out = all_rows.loc[touched, ["at", "message_id", "price"]].assign(
            commodity=key[0], prev_price=all_rows["price"].to_numpy()[touched - 1], across=False, revision=int(revision) + 1, correction=~fresh[touched]
        )
        if fresh[0] or fresh[-1]:
            first, last = all_rows.iloc[0], all_rows.iloc[-1]
            edge = {"commodity": key[0], "period": int(key[1]), "revision": int(revision) + 1}
            edge |= {"first_time": int(first["at"]), "first_id": first["message_id"], "first_price": float(first["price"])}
            edge |= {"last_time": int(last["at"]), "last_id": last["message_id"], "last_price": float(last["price"])}
            yield _frame([edge], _OUT)
        if len(out):
            yield _frame(out, _OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield _frame([], _OUT)

    def close(self) -> None:
        pass


class PeriodEdges(StatefulProcessor):
    """State of one commodity: first and last observation of each of its periods, in order."""

    def __init__(self, keep: int | None):
        self.keep = keep

    def init(self, handle) -> None:
        self.state = handle.getValueState("edges", _EDGE_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in _EDGES.split(", ")]
        held = self.state.get() if self.state.exists() else None
        revision = int(held[-1]) + 1 if held else 1
        known = {p: e for p, *e in zip(*held[:-1], strict=True)} if held else {}
        new = pd.concat(list(rows)).sort_values("revision")
        fresh = {int(p): [int(e[0]), e[1], float(e[2]), int(e[3]), e[4], float(e[5])] for p, *e in new[["period", *columns]].itertuples(index=False)}
        both = known | fresh
        order, out = sorted(both), []
        for before, p in zip(order, order[1:]):
            edge, prev = both[p], both[before]
            same_row = p in known and known[p][:3] == edge[:3]
            # The predecessor a known first row had so far, if it had one.
            last = max((q for q in known if q < p), default=None) if same_row else None
            if p in fresh or before in fresh:
                if not (same_row and last is not None and known[last][3:] == prev[3:]):
                    row = {"commodity": key[0], "at": edge[0], "message_id": edge[1], "price": edge[2], "prev_price": prev[5]}
                    out.append(row | {"across": True, "revision": revision, "correction": last is not None})
        if self.keep is not None and order:
            cut = [p for p in order if p < order[-1] - self.keep]
            for p in cut[:-1]:
                del both[p]
        order = sorted(both)
        self.state.update((order, *([both[p][i] for p in order] for i in range(6)), revision))
        yield _frame(out, _CHANGE)

    def close(self) -> None:
        pass


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", F.timestamp_micros("at").cast("timestamp_ntz")).drop("at")


def _observations(stream: DataFrame, width: int, horizon: str | None) -> DataFrame:
    rows = priced(stream.select("commodity", "event_time", "message_id", "price"), "event_time")
    rows = rows.withColumn("event_time", F.col("event_time").cast("timestamp"))
    if horizon:
        rows = rows.withWatermark("event_time", horizon)
    at = F.unix_micros("event_time")
    return rows.select("commodity", F.floor(at / F.lit(width * 1_000_000)).alias("period"), at.alias("at"), "message_id", "price", "event_time")


def changes(stream: DataFrame, path: str, width: int = DAY, horizon: str | None = None, threshold: float = dims.ALERT_PCT) -> DataStreamWriter:
    """First job: changes inside periods to ``path/changes``, edges of periods to ``path/edges``, both per batch."""
    keyed_state(stream.sparkSession)
    rows = _observations(stream, width, horizon)
    found = rows.groupBy("commodity", "period").transformWithStateInPandas(PeriodObservations(width, bool(horizon)), _OUT, "append", "eventTime" if horizon else "none")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            edges = batch.filter("period is not null").select("commodity", "period", "revision", *(c.split()[0] for c in _EDGES.split(", ")))
            edges.coalesce(1).write.mode("overwrite").parquet(f"{path}/edges/batch={batch_id}")
            _write_changes(batch.filter("period is null"), f"{path}/changes", batch_id, threshold)
        finally:
            batch.unpersist()

    return found.writeStream.foreachBatch(write)


def edge_changes(spark: SparkSession, path: str, keep_periods: int | None = None, threshold: float = dims.ALERT_PCT) -> DataStreamWriter:
    """Second job: changes across periods, from the edges that the first one wrote, to ``path/across``."""
    keyed_state(spark)
    edges = spark.readStream.schema(f"commodity string, period long, revision long, {_EDGES}").parquet(f"{path}/edges")
    found = edges.groupBy("commodity").transformWithStateInPandas(PeriodEdges(keep_periods), _CHANGE, "append", "none")
    return found.writeStream.foreachBatch(lambda batch, batch_id: _write_changes(batch, f"{path}/across", batch_id, threshold))


_WRITTEN = "commodity string, price double, prev_price double, pct_change double, direction string, status string, obs_date date, hour int, event_time timestamp_ntz, message_id string, across boolean, revision bigint"


def _write_changes(batch: DataFrame, path: str, batch_id: int, threshold: float) -> None:
    """Significant changes, and corrections of whatever size."""
    rows = _typed(batch.select(*(c.split()[0] for c in _CHANGE.split(", "))))
    marked = classify_changes(rows, threshold, keep=F.col("correction")).withColumn("hour", F.hour("event_time"))
    spans.write(marked.select(*(c.split()[0] for c in _WRITTEN.split(", "))), path, batch_id, newest)


def newest(found: DataFrame) -> DataFrame:
    """The newest result of each observation. Inside a period beats across: an observation only stops being a period's first."""
    order = Window.partitionBy("commodity", "event_time", "message_id").orderBy("across", F.desc("revision"))
    return found.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def current(spark: SparkSession, path: str) -> DataFrame:
    """The alerts as they stand, with all corrections."""
    both = spans.read(spark, f"{path}/changes", _WRITTEN).unionByName(spans.read(spark, f"{path}/across", _WRITTEN))
    return newest(both).filter(F.col("status") != "NORMAL").select(*ALERT_COLUMNS)
