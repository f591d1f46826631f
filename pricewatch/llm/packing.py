"""Variable-capacity best-fit packing of documents into training sequences.

Best-fit decreasing looks only at lengths, and a piece is at most ``max(capacities)`` tokens long, so the whole packing of any
number of pieces follows from the histogram of their lengths. The histogram (bounded by the largest capacity) goes to the
driver, which packs all equal lengths at once: pieces go to the open bins with the least room they fit into, else bins of the
least-cost size are opened; at the end each bin shrinks to the smallest permitted size that holds its contents. Several
opening rules are tried and the plan with the least total cost is taken. Spark sorts the pieces by length, numbers them, and
each piece looks its bin up in the plan by its number.

The result equals a piece-by-piece best-fit decreasing over all pieces; no piece is truncated or dropped.

Defined cases: a null or empty text is one piece that holds only the end token; a text longer than the largest capacity is cut
into full pieces and a rest; pieces of equal length are ordered by id (nulls first) and piece; repeated rows are packed each.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.common import partitions, stored

CAPACITIES = (512, 1024, 2048, 4096)
#: Pieces one sorted partition holds, on average.
PIECES_PER_PARTITION = 2_000_000
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"


def attention_cost(capacity: int) -> float:
    """Cost of a sequence: linear layers, attention over its length, and a fixed part."""
    return capacity + capacity * capacity / 16384 + 32


@dataclass
class Plan:
    """Runs of pieces in descending length: pieces ``first`` .. go to bins from ``bin`` on, ``each`` pieces a bin, behind ``used`` tokens."""

    capacities: tuple[int, ...]
    first: list[int] = field(default_factory=list)
    length: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    used: list[int] = field(default_factory=list)
    bin_first: list[int] = field(default_factory=list)
    bin_size: list[int] = field(default_factory=list)
    bins: int = 0
    cost: float = 0.0


def plan(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES, cost=attention_cost) -> Plan:
    """The cheapest of the plans that different largest opening sizes give."""
    capacities = tuple(sorted(set(capacities)))
    longest = max(histogram, default=0)
    if longest > capacities[-1]:
        raise ValueError("a piece is longer than the largest capacity")
    rules = [c for c in capacities if c >= longest]
    return min((_fill(histogram, capacities, rule, cost) for rule in rules), key=lambda p: p.cost)


def opening_size(length: int, capacities: tuple[int, ...], largest: int, cost, supply) -> int:
    """The permitted size with the least cost per token it can be filled with; the smaller one of equals."""
    sizes = [c for c in capacities if length <= c <= largest]
    return min(sizes, key=lambda c: (cost(c) / (length + min(c - length, supply(c - length))), c))


def _fill(histogram: dict[int, int], capacities: tuple[int, ...], largest: int, cost) -> Plan:
    out = Plan(capacities)
    lengths = sorted((n for n, k in histogram.items() if k), reverse=True)
    # Tokens of all pieces of at most x: what could fill a room of x.
    tokens = np.zeros(capacities[-1] + 1, dtype=np.int64)
    for n in lengths:
        tokens[n] = n * histogram[n]
    below = np.cumsum(tokens)
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    groups: dict[int, list[tuple[int, int, int]]] = {}  # room -> ranges of bins (first, end, size opened)
    closed: list[tuple[int, int, int, int]] = []  # first, end, size, room
    number = 0

    def put(room: int, bins: tuple[int, int, int]) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append(bins)

    def run(length: int, first_bin: int, size: int, room: int, each: int, pieces: int) -> None:
        nonlocal number
        for name, x in (("first", number), ("length", length), ("bin", first_bin), ("each", each), ("used", size - room)):
            getattr(out, name).append(int(x))
        number += pieces

    for n in lengths:
        left = histogram[n]
        while left:
            at = bisect_left(rooms, n)
            if at < len(rooms):
                room = rooms[at]
                a, b, size = groups[room].pop(0)
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                size = opening_size(n, capacities, largest, cost, lambda room: int(below[room]))
                room, a = size, out.bins
                out.bins = b = a + max(1, left // (size // n))
            each = room // n
            full = min(b - a, left // each)
            if full:
                run(n, a, size, room, each, full * each)
                put(room - each * n, (a, a + full, size))
                left, a = left - full * each, a + full
            if a < b and left and left < each:
                run(n, a, size, room, left, left)
                put(room - left * n, (a, a + 1, size))
                left, a = 0, a + 1
            if a < b:
                groups.setdefault(room, [])
                if room not in rooms:
                    insort(rooms, room)
                groups[room].insert(0, (a, b, size))
    for room, ranges in groups.items():
        closed += [(a, b, size, room) for a, b, size in ranges]
    for a, b, size, room in sorted(closed):
        final = next(c for c in capacities if c >= size - room)
        out.bin_first.append(a)
        out.bin_size.append(final)
        out.cost += (b - a) * cost(final)
    return out


def word_tokens(text: Column) -> Column:
    """Words separated by ASCII white space, and one end token."""
    t = F.coalesce(text, F.lit(""))
    return F.size(F.array_remove(F.split(t, WORD_SPLIT), "")) + F.lit(1)


def pieces(docs: DataFrame, id_col: str, length: Column, largest: int) -> DataFrame:
    """doc_id, piece, start, n_tokens: each document cut into full pieces and a rest."""
    n = docs.select(F.col(id_col).cast("long").alias("doc_id"), length.cast("long").alias("n"))
    cut = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / largest) - 1, F.lit(0)).cast("int"))).alias("piece")
    start = F.col("piece").cast("long") * largest
    return n.select("doc_id", "n", cut).select("doc_id", "piece", start.alias("start"), F.least(F.lit(largest), F.col("n") - start).cast("int").alias("n_tokens"))


PACKED = "doc_id long, piece int, start long, n_tokens int, bin_id long, bin_size int, bin_offset int"


def pack(docs: DataFrame, id_col: str = "doc_id", length: Column | None = None, capacities: tuple[int, ...] = CAPACITIES, cost=attention_cost) -> DataFrame:
    """One row per piece: doc_id, piece, start, n_tokens, bin_id, bin_size, bin_offset."""
    spark, largest = docs.sparkSession, max(capacities)
    cut = stored(pieces(docs, id_col, word_tokens(F.col("text")) if length is None else length, largest), "pieces")
    order = [F.col("n_tokens").desc(), F.col("doc_id").asc_nulls_first(), F.col("piece")]
    n = partitions(spark, cut.count(), PIECES_PER_PARTITION)
    ordered = cut.repartitionByRange(n, *order).sortWithinPartitions(*order)
    at = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered-pieces")
    # Rows: at most one per length for each capacity unit, and one per partition.
    histogram = {r.n_tokens: r.k for r in at.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("k")).collect()}
    parts = at.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count(F.lit(1)).alias("k")).orderBy("part").collect()
    offsets, total = {}, 0
    for r in parts:
        offsets[r.part], total = total, total + r.k
    return at.mapInArrow(_assign(plan(histogram, capacities, cost), offsets), PACKED)


def _assign(p: Plan, offsets: dict[int, int]):
    before = np.zeros(max(offsets, default=0) + 1, dtype=np.int64)
    before[list(offsets)] = list(offsets.values())
    runs = {k: np.array(getattr(p, k), dtype=np.int64) for k in ("first", "length", "bin", "each", "used", "bin_first", "bin_size")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column("at").to_numpy(zero_copy_only=False)
            number = (at & ((1 << 33) - 1)) + before[at >> 33]
            k = np.searchsorted(runs["first"], number, "right") - 1
            inside = number - runs["first"][k]
            bin_id = runs["bin"][k] + inside // runs["each"][k]
            offset = runs["used"][k] + inside % runs["each"][k] * runs["length"][k]
            size = runs["bin_size"][np.searchsorted(runs["bin_first"], bin_id, "right") - 1]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(bin_id), pa.array(size.astype(np.int32)), pa.array(offset.astype(np.int32))],
                names=["doc_id", "piece", "start", "n_tokens", "bin_id", "bin_size", "bin_offset"],
            )

    return run
