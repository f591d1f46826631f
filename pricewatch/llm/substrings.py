"""Repeated byte strings by a distributed merge sort of suffixes that never compares a known common prefix again.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in the same text or in another. Sorting the
suffixes at every byte would ship some hundred times the input, so the suffix array is sparse, at anchors that the text itself chooses:
the anchor of a window of ``LENGTH`` bytes is the first of its ``GRAM``-byte grams with the least hash. Equal windows have their anchor
at the same offset, so a window can only repeat at another anchor with the same gram, whose suffix starts with that gram too.

1. :func:`units`: the windows of one anchor are consecutive; a unit is an anchor with the starts of its windows, about one per 140 bytes.
2. :func:`kept`: units whose gram stands in one place only can't repeat and leave, before any text is moved. Equal texts are one text
   with a count; from ``LENGTH`` bytes on, all bytes of a text that repeats whole go.
3. :func:`runs`: each task sorts the suffixes at its anchors (from the anchor to the end of its last window) and front-codes them: of each
   suffix only the length of the prefix it shares with the one before, and the rest. So it does with the bytes before the anchor,
   backwards. Runs are dealt by gram.
4. :class:`LoserTree` merges a partition's runs. Its nodes keep the common prefix of each loser with the last winner; two suffixes are
   compared only beyond equal known prefixes. It gives the sorted suffixes with the length of the prefix common to neighbours.
5. :func:`repeated_windows`: among suffixes with one gram, the window at offset o before the anchor equals another's if LENGTH - o bytes
   after and o bytes before the anchor are common. Both follow from the minima of neighbours' common lengths, without pairs.
6. Spans of repeated windows return to their texts, merged, and are cut.

A gram at more than ``HOT`` places would gather them all in one task. Its windows are dealt by the digest of each instead (128 bits, counted
before the shuffle): more rows, but no group that can't be split. Everything else is exact by comparison.

Defined cases: a null text is an empty one, without bytes, spans or windows; so are texts under ``LENGTH`` bytes, which stay whole. Rows that
repeat an id or a whole row are texts of their own: each repeats the other. A null id is an id. Very long texts are read in parts of
``PART`` windows; nothing else is limited. What is left may not be UTF-8 any more, so it is binary. An empty table gives none.
Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.common import partitions, stored, utf8

LENGTH, GRAM = 400, 128
#: Places of one gram that one task may gather.
HOT = 50_000
#: Window starts looked at together, units of one merge on average, bytes of suffixes that a task holds before it writes a run.
PART, MERGE, HELD = 1 << 20, 30_000, 1 << 26
#: Numbers of one step of :func:`repeated_windows`.
_CELLS = 1 << 21

# ---- anchors

_GRAMS = LENGTH - GRAM + 1
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
#: The low bits of a key hold the place, so that the first of equal hashes wins.
_PLACE = np.uint64((1 << (PART + LENGTH).bit_length()) - 1)
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 14)
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b & (1 << 64) - 1, dtype=np.uint64)]) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _powers[0][:n], _powers[1][:n]


def _anchors(part: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(part, dtype=np.uint8)
    up, down = _power(len(codes))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    gram = (sums[GRAM:] - sums[:-GRAM]) * down[: len(codes) - GRAM + 1]
    gram ^= gram >> np.uint64(32)
    gram *= _MIX
    gram ^= gram >> np.uint64(29)
    key = gram & ~_PLACE | np.arange(len(gram), dtype=np.uint64)
    whole = np.full(-(-len(key) // _GRAMS) * _GRAMS, np.iinfo(np.uint64).max, dtype=np.uint64)
    whole[: len(key)] = key
    rows = whole.reshape(-1, _GRAMS)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(rows, axis=1).ravel()
    windows = len(part) - LENGTH + 1
    anchor = (np.minimum(ahead[:windows], behind[_GRAMS - 1 : _GRAMS - 1 + windows]) & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    return first, np.diff(first, append=windows), anchor[first], gram[anchor[first]].view(np.int64)


def anchors(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first window start, number of starts, anchor, hash of its gram) of the text's units, part by part."""
    for at in range(0, len(text) - LENGTH + 1, PART):
        start, n, anchor, gram = _anchors(text[at : at + PART + LENGTH - 1])
        yield start + at, n, anchor + at, gram


_OFFSET = 9  # bits of a number below LENGTH + 1


def units(texts: DataFrame) -> DataFrame:
    """gram, text_id, at (first start, starts, anchor's distance from the first) of every unit of ``texts`` (text_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text_id, text in zip(batch.column("text_id"), batch.column("text"), strict=True):
                for start, n, anchor, gram in anchors(text.as_py()):
                    at = start << 2 * _OFFSET | n << _OFFSET | anchor - start
                    yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array([text_id.as_py()] * len(at), pa.binary()), pa.array(at)], names=["gram", "text_id", "at"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n > 100_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return texts.filter(F.octet_length("text") >= LENGTH).mapInArrow(gathered, "gram long, text_id binary, at long")


def several(rows: DataFrame, key: str, place: list[str]) -> DataFrame:
    """The rows whose key is at more than one place. Keys are counted in every task first and written, so that both sides of the join
    are plain shuffles, of which Spark splits the parts of hot keys."""
    mark = F.xxhash64(*place)
    keys = rows.groupBy(key).agg(F.min(mark).alias("a"), F.max(mark).alias("b")).filter("a <> b").select(key)
    return rows.join(stored(keys, f"repeated-{key}"), key)


def kept(found: DataFrame) -> DataFrame:
    """The units whose gram stands at more than one place of distinct texts, once each."""
    # Dealt anew by place: rows of a hot gram need not meet.
    return several(found, "gram", ["text_id", "at"]).repartition("text_id", "at").distinct()


# ---- front-coded runs


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(strings: Sequence[bytes]) -> tuple[bytes, bytes, bytes]:
    """(lengths shared with the string before, lengths of the rest, the rests) of strings in any order."""
    shared = [common(a, b) for a, b in zip([b"", *strings], strings, strict=False)]
    rest = [s[k:] for s, k in zip(strings, shared, strict=True)]
    return np.array(shared, dtype=np.uint16).tobytes(), np.array([len(r) for r in rest], dtype=np.uint16).tobytes(), b"".join(rest)


def front_decode(shared: bytes, lengths: bytes, rest: bytes) -> tuple[list[bytes], list[int]]:
    """The strings and the lengths shared with the one before."""
    out, at, last = [], 0, b""
    known = np.frombuffer(shared, dtype=np.uint16).tolist()
    for k, n in zip(known, np.frombuffer(lengths, dtype=np.uint16).tolist(), strict=True):
        last = last[:k] + rest[at : at + n]
        out.append(last)
        at += n
    return out, known


_RUN = "part int, ids binary, at binary, shared binary, lengths binary, rest binary, back_shared binary, back_lengths binary, back_rest binary"
Unit = tuple[bytes, bytes, bytes, int]


def _write(part: int, held: list[Unit]) -> list:
    held.sort(key=lambda u: u[0])
    ids, at = b"".join(u[2] for u in held), np.array([u[3] for u in held], dtype=np.int64).tobytes()
    return [part, ids, at, *front_code([u[0] for u in held]), *front_code([u[1] for u in held])]


def cut_unit(text: bytes, at: int) -> tuple[bytes, bytes]:
    """(bytes from the anchor to the end of the last window, bytes before the anchor backwards)."""
    start, n, off = at >> 2 * _OFFSET, at >> _OFFSET & (1 << _OFFSET) - 1, at & (1 << _OFFSET) - 1
    return text[start + off : start + n - 1 + LENGTH], text[start : start + off][::-1]


def _open(batch: pa.RecordBatch) -> Iterator[tuple[bytes, bytes, list[int], list[int]]]:
    """(text_id, text, grams, places) of packed texts with their units."""
    unpack = zstandard.ZstdDecompressor().decompress
    for text_id, packed, mine in zip(*(batch.column(c) for c in ("text_id", "packed", "units")), strict=True):
        both = mine.values
        yield text_id.as_py(), unpack(packed.as_py()), both.field("gram").to_pylist(), both.field("at").to_pylist()


def runs(work: DataFrame, parts: int) -> DataFrame:
    """Sorted front-coded runs of the suffixes at the anchors, one row per run and partition of the merge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Unit]] = {}
        size = 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*(_write(p, held[p]) for p in sorted(held)), strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(columns)], names=[c.split()[0] for c in _RUN.split(", ")])

        for batch in batches:
            for text_id, text, grams, places in _open(batch):
                for gram, at in zip(grams, places, strict=True):
                    after, before = cut_unit(text, at)
                    held.setdefault(gram % parts, []).append((after, before, text_id, at))
                    size += len(after) + len(before) + 200
                    if size > HELD:
                        yield out()
                        held, size = {}, 0
        if held:
            yield out()

    return work.mapInArrow(run, _RUN)


# ---- merge


class LoserTree:
    """Merges sorted runs of (strings, lengths shared with the string before).

    A node holds the loser of its match and the length of the prefix it shares with the winner, which is the last string given out.
    The next string of the winner's run knows from its run what it shares with that. On the way up, the one that shares more
    is the smaller one; only at equal lengths bytes are compared, from there on, and the loser learns what it shares with the new winner.
    """

    def __init__(self, found: list[tuple[list[bytes], list[int]]]):
        self.runs = found
        self.size = 1 << max(0, len(found) - 1).bit_length()
        self.at = [0] * self.size
        self.now: list[bytes | None] = [r[0][0] if r[0] else None for r in found] + [None] * (self.size - len(found))
        self.known = [0] * self.size
        self.loser = [0] * self.size
        self.compared = 0
        self.winner = self._start(1)

    def _beats(self, a: int, b: int) -> bool:
        """Whether run ``a`` wins; the loser's common prefix with the winner is set."""
        x, y = self.now[a], self.now[b]
        if y is None or x is None:
            return y is None
        p, q = self.known[a], self.known[b]
        if p != q:
            return p > q
        n = common(x, y, p)
        self.compared += n - p + 1
        won = n == len(x) or n < len(y) and x[n] < y[n]
        self.known[b if won else a] = n
        return won

    def _start(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._start(2 * node), self._start(2 * node + 1)
        won = self._beats(a, b)
        self.loser[node] = b if won else a
        return a if won else b

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """(run, place in it, length shared with the string given before) in sorted order."""
        w = self.winner
        while self.now[w] is not None:
            yield w, self.at[w], self.known[w]
            self.at[w] = k = self.at[w] + 1
            strings, shared = self.runs[w]
            self.now[w], self.known[w] = (strings[k], shared[k]) if k < len(strings) else (None, 0)
            node = (w + self.size) >> 1
            while node:
                other = self.loser[node]
                if self._beats(other, w):
                    self.loser[node], w = w, other
                node >>= 1


def repeated_windows(shared: list[int], before: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(place, least offset, greatest offset) of the windows that repeat, for suffixes of one gram in sorted order.

    ``shared``: lengths shared with the suffix before, the first unused; ``before``: the bytes before each anchor, backwards.
    """
    m = len(before)
    right = np.array([0, *shared[1:], 0])
    order = sorted(range(m), key=before.__getitem__)
    left = np.array([0, *(common(before[a], before[b]) for a, b in zip(order, order[1:], strict=False)), 0])
    most_left = np.empty(m, dtype=np.int64)
    most_left[order] = np.maximum(left[:-1], left[1:])
    # A window that repeats shares LENGTH bytes with a partner in all, and neither side shares more with any than with a neighbour.
    able = np.maximum(right[:-1], right[1:]) + most_left >= LENGTH
    if not able.any():
        return
    if m == 2:
        yield from ((j, LENGTH - int(right[1]), int(left[1])) for j in (0, 1))
        return
    lowest, highest = int(LENGTH - right.max()), int(left.max())
    rank = np.empty(m, dtype=np.int64)
    rank[order] = np.arange(m)
    step = max(1, _CELLS // m)
    marks = np.zeros((m, highest - lowest + 1), dtype=bool)
    able_at = np.flatnonzero(able)
    for o in range(lowest, highest + 1, step):
        offsets = np.arange(o, min(o + step, highest + 1))
        after = (right[:-1, None] < LENGTH - offsets).cumsum(axis=0)[able_at]
        back = (left[:-1, None] < offsets).cumsum(axis=0)[rank[able_at]]
        key = (after * (m + 1) + back) * len(offsets) + np.arange(len(offsets))
        _, inverse, count = np.unique(key.ravel(), return_inverse=True, return_counts=True)
        marks[able_at, o - lowest : o - lowest + len(offsets)] = (count > 1)[inverse].reshape(key.shape)
    edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    first, last = np.argwhere(edge == 1), np.argwhere(edge == -1)
    yield from ((int(j), int(a) + lowest, int(b) - 1 + lowest) for (j, a), (_, b) in zip(first, last, strict=True))


def _merge(table: pa.Table) -> pa.Table:
    """text_id, first and last start of repeated windows, of one partition's runs."""
    after, before, ids, places = [], [], [], []
    for r in table.to_pylist():
        after.append(front_decode(r["shared"], r["lengths"], r["rest"]))
        before.append(front_decode(r["back_shared"], r["back_lengths"], r["back_rest"])[0])
        ids.append(r["ids"])
        places.append(np.frombuffer(r["at"], dtype=np.int64).tolist())
    size, out = len(ids[0]) // len(places[0]), []

    def close(group: list[tuple[int, int, int]]) -> None:
        if len(group) < 2:
            return
        for j, least, most in repeated_windows([g[2] for g in group], [before[g[0]][g[1]] for g in group]):
            r, k, _ = group[j]
            anchor = (places[r][k] >> 2 * _OFFSET) + (places[r][k] & (1 << _OFFSET) - 1)
            out.append((ids[r][size * k : size * k + size], anchor - most, anchor - least))

    group: list[tuple[int, int, int]] = []
    for found in LoserTree(after):
        if found[2] < GRAM:
            close(group)
            group = []
        group.append(found)
    close(group)
    columns = list(zip(*out, strict=True)) or [(), (), ()]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("text_id", "first", "last"), columns, (pa.binary(), pa.int64(), pa.int64()), strict=True)})


_STARTS = "text_id binary, first long, last long"


def digests(work: DataFrame) -> DataFrame:
    """window (digest of its bytes), text_id, first: every window of the units at hand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text_id, text, _, places in _open(batch):
                for at in range(0, len(places), 512):
                    starts = [s for p in places[at : at + 512] for s in range(p >> 2 * _OFFSET, (p >> 2 * _OFFSET) + (p >> _OFFSET & (1 << _OFFSET) - 1))]
                    found = [xxhash.xxh3_128_digest(text[s : s + LENGTH]) for s in starts]
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([text_id] * len(starts), pa.binary()), pa.array(starts, pa.int64())], names=["window", "text_id", "first"])

    return work.mapInArrow(run, "window binary, text_id binary, first long")


# ---- the whole


def packed(texts: DataFrame) -> DataFrame:
    """text_id, packed: each distinct text once, compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("text_id"), pa.array([pack(t.as_py()) for t in batch.column("text")], pa.binary())], names=["text_id", "packed"])

    small = texts.filter(F.octet_length("text") >= LENGTH).mapInArrow(run, "text_id binary, packed binary")
    return small.groupBy("text_id").agg(F.first("packed").alias("packed"))


def with_units(texts: DataFrame, found: DataFrame) -> DataFrame:
    mine = found.groupBy("text_id").agg(F.collect_list(F.struct("gram", "at")).alias("units"))
    return packed(texts).join(mine, "text_id")


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (of the whole text), text_id (its first half), text (bytes) of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), utf8(F.col(f"`{text_col}`")).alias("text"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256))).withColumn("text_id", F.substring("digest", 1, 16))


def starts(texts: DataFrame) -> DataFrame:
    """text_id, first, last: starts of windows that repeat at another place of the distinct ``texts`` (text_id, text)."""
    texts = texts.select("text_id", "text")
    found = stored(kept(stored(units(texts), "units")), "repeated-grams")
    hot = stored(found.groupBy("gram").count().filter(F.col("count") > HOT).select("gram"), "hot-grams")
    cold = found.join(hot, "gram", "left_anti")
    parts = partitions(texts.sparkSession, found.count(), MERGE)
    merged = runs(with_units(texts, cold), parts).groupBy("part").applyInArrow(_merge, _STARTS)
    if hot.isEmpty():
        return merged
    windows = stored(digests(with_units(texts, found.join(hot, "gram", "left_semi"))), "hot-windows")
    again = stored(several(windows, "window", ["text_id", "first"]).select("text_id", "first"), "hot-repeats")
    return merged.union(again.select("text_id", "first", F.col("first").alias("last")))


def spans(found: DataFrame) -> DataFrame:
    """text_id, spans (offset, length) of the bytes to remove, merged and in order."""
    each = found.select("text_id", F.struct(F.col("first").alias("a"), (F.col("last") + LENGTH).alias("b")).alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for mine in batch.column("all"):
                both = mine.values
                a, b = (both.field(c).to_numpy() for c in ("a", "b"))
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.flatnonzero(np.r_[True, a[1:] > b[:-1]])
                ends = b[np.r_[new[1:] - 1, len(b) - 1]]
                out.append([{"offset": int(x), "length": int(y - x)} for x, y in zip(a[new], ends, strict=True)])
            kind = pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("text_id"), pa.array(out, kind)], names=["text_id", "spans"])

    return each.groupBy("text_id").agg(F.collect_list("s").alias("all")).mapInArrow(run, "text_id binary, spans array<struct<offset: long, length: long>>")


def remove(text: bytes, cut: list[dict[str, int]]) -> bytes:
    at, out = 0, []
    for s in cut:
        out.append(text[at : s["offset"]])
        at = s["offset"] + s["length"]
    return b"".join([*out, text[at:]])


def cut_texts(texts: DataFrame, found: DataFrame) -> DataFrame:
    """text_id, spans, kept (the bytes left), kept_digest of the texts that have spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            left = [remove(unpack(p.as_py()), s.as_py()) for p, s in zip(batch.column("packed"), batch.column("spans"), strict=True)]
            found = [hashlib.sha256(x).digest() for x in left]
            columns = [batch.column("text_id"), batch.column("spans"), pa.array(left, pa.binary()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["text_id", "spans", "kept", "kept_digest"])

    return packed(texts).join(found, "text_id").mapInArrow(run, "text_id binary, spans array<struct<offset: long, length: long>>, kept binary, kept_digest binary")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (offset and length of what goes), kept (the bytes left), kept_digest (their SHA-256) of every row.

    ``kept`` is null where a text stays whole; the column is only made if it is selected.
    """
    rows = numbered(docs, id_col, text_col)
    cut = cut_texts(rows, spans(stored(starts(rows), "repeated-windows")))
    return _decide(rows, cut)


def _decide(rows: DataFrame, cut: DataFrame) -> DataFrame:
    copies = rows.groupBy("text_id").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    n = F.octet_length("text").cast("long")
    all_rows = rows.select("doc_id", "text_id", "digest", n.alias("n_bytes")).join(copies, "text_id", "left").join(cut, "text_id", "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("offset"), F.col("n_bytes").alias("length")))
    nothing = F.array().cast("array<struct<offset: long, length: long>>")
    return all_rows.select(
        "doc_id",
        "n_bytes",
        F.when(whole, everything).otherwise(F.coalesce("spans", nothing)).alias("spans"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(whole, F.lit(hashlib.sha256(b"").digest())).otherwise(F.coalesce("kept_digest", "digest")).alias("kept_digest"),
    )
