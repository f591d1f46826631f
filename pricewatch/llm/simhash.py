"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints of 64 bits link at ``RADIUS`` = 3 or fewer differing bits. The bits are split into four blocks. For each block,
every distinct fingerprint emits the variants of its other 48 bits within distance 1, half the radius: 4 x 49 rows. They are
shuffled on the variant, and rows that meet there are tied without looking at pairs:

* members of one variant that agree in the left-out block differ in at most 2 bits, so a star to the first of them is exact;
* two such sets whose block values differ in one bit differ in at most 3 bits, so one edge between their firsts is exact;
* members that hold the variant itself and whose block values differ in 3 bits are linked too.

Every pair at distance 3 or less meets in at least one of these: of its differing bits either one lies alone in a block, or
all lie in one block. All edges are verified by their distance. The number of rows grows with the number of distinct
fingerprints only; copies are counted before. Each partition reduces its edges to a forest, and components follow from
alternating large-star and small-star rounds on the forests' edges, each round written to the shared folder.

Defined cases: a null or empty text has fingerprint zero, linked like any other; a null id never names a component unless all
its ids are null; rows that repeat an id and a text are one document; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.common import partitions, pick_rows, stored, utf8

RADIUS = 3
BLOCKS, BLOCK_BITS = 4, 16
SHINGLE = 3
SEED = 42
#: Variant rows one partition holds, on average (about 100 bytes each in the worker).
VARIANTS_PER_PARTITION = 1_500_000
#: Shingle hashes counted at a time.
_SLICE = 1 << 15

_hash = partial(xxhash.xxh64_digest, seed=SEED)


def fingerprint(text: bytes) -> int:
    """SimHash of the text's word shingles, as a signed 64-bit number."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) < SHINGLE:
        shingles, n = iter([b" ".join(found)]), 1
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(SHINGLE)), strict=False))
        n = len(found) - SHINGLE + 1
    ones = np.zeros(64, dtype=np.int64)
    hashes = b"".join(map(_hash, shingles))
    for at in range(0, len(hashes), 8 * _SLICE):
        part = np.frombuffer(hashes[at : at + 8 * _SLICE], dtype=np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (hash of the text), fp: one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = pa.array([fingerprint(t.as_py()) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), fp], names=["doc_id", "key", "fp"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text_col}`").alias("key"), utf8(F.col(f"`{text_col}`")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, fp long")


# ---- links


def _masks() -> list[tuple[int, int, int, int]]:
    """(block, kept bits, bit to flip, number of the flip) of every variant."""
    out = []
    for block in range(BLOCKS):
        hole = ((1 << BLOCK_BITS) - 1) << BLOCK_BITS * block
        flips = [0] + [1 << i for i in range(64) if not hole >> i & 1]
        out += [(block, ~hole, flip, k) for k, flip in enumerate(flips)]
    return out


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def variants(distinct: DataFrame) -> DataFrame:
    """key (the variant), tag (block, flip and the left-out block's value) for every fingerprint ``fp``."""
    made = F.array(*(F.struct(F.lit(b).alias("b"), F.lit(_signed(keep)).alias("keep"), F.lit(_signed(flip)).alias("flip"), F.lit(k).alias("k")) for b, keep, flip, k in _masks()))
    rows = distinct.select("fp", F.explode(made).alias("m"))
    value = F.expr(f"cast(shiftrightunsigned(fp, m.b * {BLOCK_BITS}) & {(1 << BLOCK_BITS) - 1} as int)")
    tag = F.shiftleft(F.col("m.b") * 64 + F.col("m.k"), BLOCK_BITS).bitwiseOR(value)
    return rows.select(F.col("fp").bitwiseAND(F.col("m.keep")).bitwiseXOR(F.col("m.flip")).alias("key"), tag.alias("tag"))


_FLIPS = np.array([m[2] for m in _masks()], dtype=np.uint64).reshape(BLOCKS, -1)
#: All differences of three bits in a block.
_THREE = np.array([1 << a | 1 << b | 1 << c for a in range(BLOCK_BITS) for b in range(a) for c in range(b)], dtype=np.int64)
_ONE = np.array([1 << a for a in range(BLOCK_BITS)], dtype=np.int64)


def _near(code: np.ndarray, differences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``code`` (sorted, distinct; the block value in the low bits) that differ by one of the differences."""
    left, right = [], []
    for x in differences:
        other = code ^ x
        at = np.minimum(np.searchsorted(code, other), len(code) - 1)
        hit = np.flatnonzero((code[at] == other) & (code < other))
        left.append(hit)
        right.append(at[hit])
    return np.concatenate(left), np.concatenate(right)


def variant_edges(key: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """Edges (n x 2 fingerprints) among the rows of whole variant groups."""
    block, flip, value = tag >> 22, tag >> BLOCK_BITS & 63, tag & 0xFFFF
    order = np.lexsort((flip, value, key, block))
    key, block, flip, value = key[order], block[order], flip[order], value[order]
    group = np.cumsum(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]) - 1
    shared = np.bincount(group)[group] > 1
    if not shared.any():
        return np.empty((0, 2), dtype=np.uint64)
    key, block, flip, value, group = (x[shared] for x in (key, block, flip, value, group))
    fp = key.view(np.uint64) ^ _FLIPS[block, flip] | value.astype(np.uint64) << (block * BLOCK_BITS).astype(np.uint64)
    code = group.astype(np.int64) << BLOCK_BITS | value
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    leader = first[np.cumsum(np.r_[True, code[1:] != code[:-1]]) - 1]
    star = np.flatnonzero(leader != np.arange(len(fp)))
    found = [np.stack([fp[leader[star]], fp[star]], 1)]
    a, b = _near(code[first], _ONE)
    found.append(np.stack([fp[first[a]], fp[first[b]]], 1))
    itself = np.flatnonzero(flip == 0)
    itself = itself[np.bincount(group[itself])[group[itself]] > 1]
    if len(itself):
        a, b = _near(code[itself], _THREE)
        found.append(np.stack([fp[itself[a]], fp[itself[b]]], 1))
    edges = np.sort(np.concatenate(found), axis=1)
    return edges[np.bitwise_count(edges[:, 0] ^ edges[:, 1]) <= RADIUS]


def forest(edges: np.ndarray) -> list[tuple[int, int]]:
    """(smallest member, other member) of each component of the edges at hand."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for a, b in np.unique(edges, axis=0).view(np.int64).tolist():
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [(r, x) for x in list(up) if (r := root(x)) != x]


def _edge_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column("key").to_numpy(), b.column("tag").to_numpy()) for b in batches if b.num_rows]
    if held:
        key, tag = (np.concatenate(x) for x in zip(*held, strict=True))
        del held
        yield _edge_batch(forest(variant_edges(key, tag.astype(np.int64))))


def links(distinct: DataFrame, count: int) -> DataFrame:
    """Edges (a < b) that span every component of the fingerprints ``fp`` (distinct, ``count`` of them)."""
    n = partitions(distinct.sparkSession, count * len(_masks()), VARIANTS_PER_PARTITION)
    return variants(distinct).repartition(n, "key").mapInArrow(_edges, "a long, b long")


# ---- components


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the smallest node it can reach."""
    edges, before = stored(edges.filter("a <> b").distinct(), "edges"), None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = stored(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "lowest").withColumn("m", F.least("u", "m"))
        large = both.join(low, F.col("a") == F.col("u")).filter("b > a").select(F.col("m").alias("a"), "b").distinct()
        large = stored(large, "large-star")
        low = stored(large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m")), "lowest")
        tied = large.join(low, F.col("b") == F.col("u"))
        small = tied.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")).union(low.select(F.col("m").alias("a"), F.col("u").alias("b")))
        edges = stored(small.distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        before = state


def classes(rows: DataFrame) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``rows``: the fingerprint that names its component."""
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "fingerprints")
    found = components(links(distinct.select("fp"), distinct.count()))
    named = distinct.join(found, distinct.fp == found.node, "left").select("fp", "low_id", F.coalesce("root", "fp").alias("root"))
    return stored(named, "classes")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, fp, root, component_id (the smallest id reachable) of every row."""
    rows = stored(fingerprints(docs, id_col, text_col), "simhash")
    named = classes(rows)
    lowest = stored(named.groupBy("root").agg(F.min("low_id").alias("component_id")), "components")
    by_fp = stored(named.select("fp", "root").join(lowest, "root"), "fingerprint-components")
    return rows.join(by_fp, "fp")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest id (nulls last)."""
    rows = stored(decide(docs, id_col, text_col), "simhash-decisions")
    rank = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))
    first = stored(rows.groupBy(F.col("root").alias("r")).agg(F.min(rank).alias("first")), "first-ids")
    mine = rows.join(first, F.col("root") == F.col("r")).filter(rank == F.col("first"))
    keyed = stored(mine.groupBy("root", "doc_id", "key").agg(F.count(F.lit(1)).alias("keep_rows")), "first-rows")
    one = keyed.groupBy(F.col("root").alias("r")).agg(F.min("key").alias("k"))
    keepers = keyed.join(one, (F.col("root") == F.col("r")) & (F.col("key") == F.col("k"))).select(F.col("doc_id").alias("keep_id"), "key", "keep_rows")
    return pick_rows(docs, id_col, F.xxhash64(f"`{text_col}`"), keepers)
