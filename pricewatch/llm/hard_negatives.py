"""Hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label. Each positive opens a window of scores, from a share of its own score
up to a larger share of it, and wants the best rows of other labels inside. The windows of one anchor overlap, so they are not
searched one by one: their upper limits, sorted, cut the scores into disjoint slots, and every row falls into one slot at most.

1. :func:`positives`: blocks of anchors meet groups of rows; each meeting keeps the best rows of the anchor's label, Spark ranks them.
2. :func:`slot_tops`: the same meetings once more; each keeps the best rows of other labels per slot, Spark ranks them per slot.
3. :func:`answers`: from the lowest slot upwards, a slot's best rows are merged with the best of all slots below. What the merge holds at
   a slot are the best rows under that upper limit, so one pass over the slots answers all windows; rows under a window's lower limit go.

A meeting holds at most about ``ROWS`` rows and ``ANCHORS`` anchors, whatever the size of the table; nothing passes through the driver.
Every anchor is scored against every row: the query set in blocks, without an index that could lose one.

Defined cases: rows with a null id, a null label, a null vector or a null or non-finite component take no part. Rows of one id are one
row, the least by label and vector. Components a vector lacks count as 0. Equal scores go by the smaller id; rows that tie in all but the
id stay apart. Scores are exact integers, and saturate at 64 bits. Anchors without positives, and positives without rows in their
window, give no rows; so does an empty table. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewatch.llm.common import stored

#: Whole numbers are taken of the components times this.
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A window goes from LOW to HIGH hundredths of the positive's score.
LOW, HIGH = 50, 95
ROWS, ANCHORS = 8192, 1024
_EXACT = 1 << 53


def prepare(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, v (whole numbers) of the rows that take part."""
    fit = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    fit = fit.filter("vec_id is not null and label is not null and x is not null").filter(finite)
    whole = fit.select("vec_id", F.struct("label", F.transform("x", lambda c: F.floor(c * SCALE).cast("long")).alias("v")).alias("r"))
    return whole.groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.v")


# ---- scores of a block


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    flat, ends = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
    lengths = np.diff(ends, prepend=0)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(ends - lengths, lengths)] = flat
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` and of ``b`` as int64."""
    most = [int(np.abs(m.astype(np.float64)).max(initial=0)) for m in (a, b)]
    if most[0] * most[1] * max(1, a.shape[1]) < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    limits = np.iinfo(np.int64)
    exact = a.astype(object) @ b.astype(object).T if a.shape[1] else np.zeros((len(a), len(b)))
    return np.clip(exact, limits.min + 1, limits.max).astype(np.int64)


def best(found: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest allowed entries of each row; equal ones go by the smaller column."""
    n = found.shape[1]
    if not n or not allowed.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    if n <= k:
        at = np.broadcast_to(np.arange(n), found.shape)
    elif int(np.abs(found.astype(np.float64)).max()) < (1 << 62) // (n + 1):
        key = np.where(allowed, found * n - np.arange(n), np.iinfo(np.int64).min)
        at = np.argpartition(key, n - k, axis=1)[:, n - k :]
    else:
        at = np.argsort(np.where(allowed, ~found, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :k]
    row = np.broadcast_to(np.arange(len(found))[:, None], at.shape)
    ok = np.take_along_axis(allowed, at, axis=1)
    return row[ok], at[ok]


def _block(anchors: pa.Table, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and labels of both sides and their scores; rows in the order of their ids."""
    anchors, rows = anchors.combine_chunks(), rows.sort_by("vec_id").combine_chunks()
    names = (("anchor_id", "anchor_label", "anchor_v"), ("vec_id", "label", "v"))
    sides = [(t.column(i).to_numpy(), t.column(c).to_numpy(), t.column(v).combine_chunks()) for t, (i, c, v) in zip((anchors, rows), names, strict=True)]
    width = max((int(v.value_lengths().to_numpy(zero_copy_only=False).max(initial=0)) for _, _, v in sides), default=0)
    (a_id, a_label, a_v), (r_id, r_label, r_v) = sides
    return a_id, a_label, r_id, r_label, scores(_matrix(a_v, width), _matrix(r_v, width))


def _found(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> pa.Table:
    return pa.table({"anchor_id": pa.array(anchor, pa.int64()), "slot": pa.array(slot, pa.int32()), "score": pa.array(score, pa.int64()), "vec_id": pa.array(vec_id, pa.int64())})


_FOUND = "anchor_id long, slot int, score long, vec_id long"


def _nearest(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    a_id, a_label, r_id, r_label, found = _block(anchors, rows)
    at, col = best(found, (a_label[:, None] == r_label) & (a_id[:, None] != r_id), POSITIVES)
    return _found(a_id[at], np.zeros(len(at)), found[at, col], r_id[col])


def _slotted(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Per anchor and slot the best rows of other labels. Slot j holds the scores above limit j + 1 and up to limit j."""
    a_id, a_label, r_id, r_label, found = _block(anchors, rows)
    other, limits = a_label[:, None] != r_label, anchors.combine_chunks().column("limits").to_pylist()
    above, parts = np.full(len(a_id), np.iinfo(np.int64).min), []
    for slot in range(max(map(len, limits), default=0) - 1, -1, -1):
        here = np.array([x[slot] if slot < len(x) else np.iinfo(np.int64).min for x in limits])
        at, col = best(found, other & (found > above[:, None]) & (found <= here[:, None]), NEGATIVES)
        parts.append(_found(a_id[at], np.full(len(at), slot), found[at, col], r_id[col]))
        above = here
    return pa.concat_tables(parts) if parts else _found(*[np.empty(0)] * 4)


def _meet(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, fn) -> DataFrame:
    """``fn`` on every block of anchors with every group of rows, both bounded."""
    blocks, groups = -(-n_anchors // ANCHORS) or 1, -(-n_rows // ROWS) or 1
    left = anchors.withColumn("b_", F.pmod(F.xxhash64("anchor_id", F.lit(1)), F.lit(blocks).cast("long"))).withColumn("g_", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    right = rows.withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(groups).cast("long"))).withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return left.groupBy("b_", "g_").cogroup(right.groupBy("b", "g")).applyInArrow(fn, _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each anchor and slot, ranked from 1; Spark keeps as many per task before it shuffles."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# ---- the three steps


def positives(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """anchor_id, score, vec_id, rank: each anchor's best other rows of its label."""
    return _first(_meet(anchors, rows, n_anchors, n_rows, _nearest), POSITIVES).drop("slot")


def limits(found: DataFrame) -> DataFrame:
    """anchor_id, limits: the distinct upper limits of its windows, highest first."""
    exact = F.expr(f"cast(floor(cast(score as decimal(20, 0)) * {HIGH} / 100) as long)")
    return found.groupBy("anchor_id").agg(F.sort_array(F.collect_set(exact), asc=False).alias("limits"))


def slot_tops(anchors: DataFrame, rows: DataFrame, found: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """anchor_id, slot, score, vec_id, rank: each slot's best rows of other labels."""
    return _first(_meet(anchors.join(limits(found), "anchor_id"), rows, n_anchors, n_rows, _slotted), NEGATIVES)


def merge_windows(pos: list[tuple[int, int]], slots: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int, int, int, int]]:
    """(positive_id, rank, negative_id, positive_score, negative_score) of one anchor. ``pos``: (score, id), ``slots``: slot -> (score, id)."""
    tops = sorted({p * HIGH // 100 for p, _ in pos}, reverse=True)
    held: list[tuple[int, int]] = []
    under: dict[int, list[tuple[int, int]]] = {}
    for slot in range(len(tops) - 1, -1, -1):
        held = sorted(slots.get(slot, []) + held, key=lambda x: (-x[0], x[1]))[:NEGATIVES]
        under[tops[slot]] = held
    out = []
    for p, i in pos:
        inside = [x for x in under[p * HIGH // 100] if 100 * x[0] >= LOW * p]
        out += [(i, rank, n, p, s) for rank, (s, n) in enumerate(inside, 1)]
    return out


def answers(found: DataFrame, tops: DataFrame) -> DataFrame:
    """One row per anchor, positive and rank. An anchor has a bounded number of positives and of slot rows."""
    pos = found.groupBy("anchor_id").agg(F.collect_list(F.struct("score", "vec_id")).alias("pos"))
    neg = tops.groupBy("anchor_id").agg(F.collect_list(F.struct("slot", "score", "vec_id")).alias("neg"))

    def run(batches):
        for batch in batches:
            out = []
            for anchor, pos, neg in zip(*(batch.column(c).to_pylist() for c in ("anchor_id", "pos", "neg")), strict=True):
                slots: dict[int, list[tuple[int, int]]] = {}
                for x in neg:
                    slots.setdefault(x["slot"], []).append((x["score"], x["vec_id"]))
                out += [(anchor, *r) for r in merge_windows([(x["score"], x["vec_id"]) for x in pos], slots)]
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(columns)], names=_ANSWER)

    return pos.join(neg, "anchor_id").mapInArrow(run, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


_ANSWER = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Hard negatives of the rows for which ``is_anchor`` (over vec_id and label) holds, among all rows."""
    rows = stored(prepare(rows, id_col, vector_col, label_col), "vectors")
    anchors = rows.filter(is_anchor).select(*(F.col(c).alias(a) for c, a in (("vec_id", "anchor_id"), ("label", "anchor_label"), ("v", "anchor_v"))))
    n_rows, n_anchors = rows.count(), anchors.count()
    found = stored(positives(anchors, rows, n_anchors, n_rows), "positives")
    return answers(found, stored(slot_tops(anchors, rows, found, n_anchors, n_rows), "slots"))
