"""Line dedup: units of text are normalised, their digests grouped over all documents, and repeats are removed.

A unit is a line. Lines are cut further after anchor words, whose hash is the least among the words around them, so that a
passage inside a longer line falls into the same units wherever it stands. Anchors are more than ``reach`` words apart, so only
the first and the last piece of a line can be shorter than ``min_words``. Such a piece repeats with its whole line, whose digest
it takes, and a line without any longer piece is one unit, however short. So a repeated line is always found as a whole, and a
repeated passage by its pieces of at least ``min_words`` words. Normalising lower-cases A-Z and joins the words with single
spaces. Of equal units the earliest stays: that of the smallest document id, and in it the first. The others are removed; their
offsets in the original text are kept.

The digests of a document's first occurrences are grouped with partial sums (a document counts once, later occurrences inside
it are repeats anyway), so a line that is in a third of all documents crosses the network a few times for each task.

Defined cases: a null text has no units; a null id ranks last and is named null; rows that repeat an id count as one document,
whose units do not remove each other; texts without repeats keep every byte; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.common import fresh, stored, utf8

MIN_WORDS = 6
#: Words on each side that an anchor word is compared with.
REACH = 5
LAST = (1 << 63) - 1

UNIT = "digest binary, rank long, unit int, start int, stop int, n_words int, repeat boolean"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _word_hashes(raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A number per word that depends on its bytes only."""
    n = len(raw)
    up = np.cumprod(np.full(n, _MULTIPLIER))
    down = np.cumprod(np.full(n, _INVERSE))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up)])
    h = (total[stop] - total[start]) * down[start]
    h = (h ^ h >> np.uint64(31)) * _MIX
    return h ^ h >> np.uint64(29)


def units(text: bytes, min_words: int = MIN_WORDS, reach: int = REACH) -> list[tuple[bytes, int, int, int, int]]:
    """(digest, number, first character, end character, words) of each unit, in order; together they hold every word once."""
    raw = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    space = np.concatenate([[True], _SPACE[raw], [True]])
    start = np.flatnonzero(space[:-1] & ~space[1:])
    if not len(start):
        return []
    stop = np.flatnonzero(~space[:-1] & space[1:])
    line = np.cumsum(raw == 10)[start]
    h = _word_hashes(raw, start, stop)
    anchor = np.ones(len(h), dtype=bool)
    for d in range(1, min(reach, len(h) - 1) + 1):
        other = line[d:] != line[:-d]
        anchor[d:] &= other | (h[d:] < h[:-d])
        anchor[:-d] &= other | (h[:-d] <= h[d:])
    last = np.append(line[1:] != line[:-1], True)
    ends = np.flatnonzero(anchor | last)
    begins = np.concatenate([[0], ends[:-1] + 1])
    # The first and the last piece of each piece's line; a line without a piece of enough words is one piece.
    closing = np.flatnonzero(last[ends])
    opening = np.concatenate([[0], closing[:-1] + 1])
    whole = np.maximum.reduceat(ends + 1 - begins, opening) < min_words
    row = np.repeat(np.arange(len(opening)), closing + 1 - opening)
    first, final = begins[opening][row], ends[closing][row]
    kept = ~whole[row] | (begins == first)
    begins, ends, first, final = begins[kept], np.where(whole[row], final, ends)[kept], first[kept], final[kept]
    character = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])
    low, out = raw.tobytes(), []
    for k, (a, b, f, g) in enumerate(zip(begins.tolist(), ends.tolist(), first.tolist(), final.tolist(), strict=True)):
        if b + 1 - a >= min_words or (a == f and b == g):
            words = b" ".join(low[start[a] : stop[b]].split())
        else:  # words hold no line end, so no other unit has this digest
            words = (b"\nfirst " if a == f else b"\nlast ") + b" ".join(low[start[f] : stop[g]].split())
        out.append((xxhash.xxh3_128_digest(words), k, int(character[start[a]]), int(character[stop[b]]), b + 1 - a))
    return out


def _units(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, rank in zip(batch.column("text"), batch.column("rank").to_pylist(), strict=True):
                seen: set[bytes] = set()
                for digest, *unit in units(text.as_py(), min_words):
                    out.append((digest, rank, *unit, digest in seen))
                    seen.add(digest)
                if len(out) >= 50_000:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["digest", "rank", "unit", "start", "stop", "n_words", "repeat"])


def all_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Every unit of every document: digest, rank (the id, nulls last), unit, start, stop, n_words, repeat (within it)."""
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("rank"), utf8(F.col(f"`{text_col}`")).alias("text"))
    return rows.mapInArrow(_units(min_words), UNIT)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per removed unit: doc_id, unit, start, stop (characters), n_words, keep_doc_id, n_docs, digest."""
    found = stored(all_units(docs, id_col, text_col, min_words), "units")
    firsts = found.filter(~F.col("repeat")).groupBy("digest").agg(F.min("rank").alias("keep"), F.count(F.lit(1)).alias("n_docs"))
    inside = found.filter("repeat").select("digest").distinct().withColumn("inside", F.lit(True))
    shared = stored(firsts.join(inside, "digest", "left").filter("n_docs > 1 or inside").drop("inside"), "shared-units")
    gone = found.join(shared, "digest").filter(F.col("repeat") | (F.col("rank") != F.col("keep")))
    return gone.select(_named("rank").alias("doc_id"), "unit", "start", "stop", "n_words", _named("keep").alias("keep_doc_id"), "n_docs", "digest")


def _named(rank: str) -> Column:
    return F.nullif(F.col(rank), F.lit(LAST))


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the repeated units, with the removed (start, stop) of the original text in ``removed``.

    Rows that share an id share the removals, which apply to a row only where its own units at that place have the digest.
    """
    rank, spans, removed = fresh("_rank", docs), fresh("_spans", docs), fresh("removed", docs)
    gone = repeats(docs, id_col, text_col, min_words)
    by_doc = gone.groupBy(F.coalesce("doc_id", F.lit(LAST)).alias(rank + "d")).agg(F.collect_set(F.struct("start", "stop", "digest")).alias(spans))
    both = docs.withColumn(rank, F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)))
    both = both.join(by_doc, F.col(rank) == F.col(rank + "d"), "left")
    made = F.udf(_cut(min_words), "struct<text:string,removed:array<struct<start:int,stop:int>>>")(F.col(f"`{text_col}`"), F.col(spans))
    result = fresh("_cut", docs)
    cut = both.withColumn(result, F.when(F.col(spans).isNotNull(), made))
    columns = [F.when(F.col(result).isNotNull(), F.col(f"{result}.text")).otherwise(F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return cut.select(*columns, F.coalesce(F.col(f"{result}.removed"), F.array().cast("array<struct<start:int,stop:int>>")).alias(removed))


def _cut(min_words: int):
    def run(text: str | None, spans) -> tuple[str | None, list[tuple[int, int]]]:
        if text is None or not spans:
            return text, []
        own = {(a, b, digest) for digest, _, a, b, _ in units(text.encode(), min_words)}
        gone = sorted((s["start"], s["stop"]) for s in spans if (s["start"], s["stop"], bytes(s["digest"])) in own)
        out, at = [], 0
        for a, b in gone:
            out.append(text[at:a])
            at = b
        return "".join([*out, text[at:]]), gone

    return run


