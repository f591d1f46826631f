"""Exact dedup: partitioned cuckoo-filter index over content digests.

Texts are equal when identical after lower-casing A-Z. Each partition of the digest space has a cuckoo filter in front of
its stored keys: a digest the filter does not know is new without a look at the keys, a hit is verified against the full
digest in the bucket it falls into, and a filter that overflows is rebuilt with twice the buckets from those keys.

Defined cases: a null text counts as empty; a null id is the smallest; equal ids with equal text are one document, so
``kept`` is true on all of its rows and :func:`deduplicate` leaves one of them; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.common import ascii_lower, partitions, pick_rows, stored

#: Digests one partition holds at most, on average (about 300 bytes each in the worker).
KEYS_PER_PARTITION = 250_000
#: Groups combined in front of the shuffle before a flush.
COMBINE_GROUPS = 50_000

ENTRY = "digest binary, keep_id long, group_size long, keep_rows long"


class CuckooIndex:
    """Filter of 16-bit marks, four to a bucket, over stored keys with a value each."""

    SLOTS = 4
    MAX_KICKS = 200

    def __init__(self, buckets: int = 64):
        self.resizes = 0
        self._clear(buckets)
        self.content: dict[int, dict[bytes, list]] = {}

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = [[] for _ in range(buckets)]

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x9E3779B1 >> 7) & self.mask

    @staticmethod
    def _key(digest: bytes) -> int:
        return int.from_bytes(digest[10:13], "little")

    def might_have(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.marks[a] or mark in self.marks[b]

    def get(self, digest: bytes) -> list | None:
        """The stored value; a filter hit counts only if the full digest is in its content bucket."""
        return self.content.get(self._key(digest), {}).get(digest) if self.might_have(digest) else None

    def insert(self, digest: bytes, value: list) -> None:
        self.content.setdefault(self._key(digest), {})[digest] = value
        if not self._place(digest):
            self._grow()

    def delete(self, digest: bytes) -> bool:
        """Take a live digest out of the filter and the content."""
        if self.get(digest) is None:
            return False
        del self.content[self._key(digest)][digest]
        mark, a, b = self._places(digest)
        self.marks[a if mark in self.marks[a] else b].remove(mark)
        return True

    def _place(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        for bucket in (a, b):
            if len(self.marks[bucket]) < self.SLOTS:
                self.marks[bucket].append(mark)
                return True
        bucket = a
        for kick in range(self.MAX_KICKS):
            row = self.marks[bucket]
            row[kick % self.SLOTS], mark = mark, row[kick % self.SLOTS]
            bucket = self._other(bucket, mark)
            if len(self.marks[bucket]) < self.SLOTS:
                self.marks[bucket].append(mark)
                return True
        return False

    def _grow(self) -> None:
        """Twice the buckets until every stored key has a place."""
        while True:
            self.resizes += 1
            self._clear(2 * (self.mask + 1))
            if all(self._place(digest) for digest, _ in self.items()):
                return

    def items(self) -> Iterator[tuple[bytes, list]]:
        for bucket in self.content.values():
            yield from bucket.items()


def _better(a: int | None, b: int | None) -> bool:
    return b is None and a is not None or (a is not None and b is not None and a > b)


def _merge(value: list, keep_id: int | None, size: int, rows: int) -> None:
    value[1] += size
    if keep_id == value[0]:
        value[2] += rows
    elif _better(keep_id, value[0]):
        value[0], value[2] = keep_id, rows


def _batch(entries: list[tuple[bytes, list]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([d for d, _ in entries], pa.binary()),
            *(pa.array([v[i] for _, v in entries], pa.int64()) for i in range(3)),
        ],
        names=["digest", "keep_id", "group_size", "keep_rows"],
    )


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest of the rows at hand, so that a hot digest leaves a task as a few rows."""
    held: dict[bytes, list] = {}
    for batch in batches:
        for digest, doc_id in zip(batch.column("digest").to_pylist(), batch.column("doc_id").to_pylist(), strict=True):
            if digest in held:
                _merge(held[digest], doc_id, 1, 1)
            else:
                held[digest] = [doc_id, 1, 1]
        if len(held) >= COMBINE_GROUPS:
            yield _batch(list(held.items()))
            held = {}
    if held:
        yield _batch(list(held.items()))


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("digest", "keep_id", "group_size", "keep_rows", "step")]
        for digest, keep_id, size, rows, step in zip(*columns, strict=True):
            if step == 1:
                index.delete(digest)
            elif (found := index.get(digest)) is not None:
                _merge(found, keep_id, size, rows)
            else:
                index.insert(digest, [keep_id, size, rows])
    entries = list(index.items())
    for at in range(0, len(entries), 10_000):
        yield _batch(entries[at : at + 10_000])


def digest_of(text_col: str) -> Column:
    """SHA-256 of the normalised text."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest) of every row."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), digest_of(text_col).alias("digest"))


def update_index(rows: DataFrame, index: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """The index after taking ``deleted`` (digest) out and then ``rows`` (doc_id, digest) in: one row per live digest."""
    spark = rows.sparkSession
    parts = rows.mapInArrow(_combine, ENTRY).withColumn("step", F.lit(2))
    if deleted is not None:
        gone = deleted.select("digest").distinct()
        zero = F.lit(0).cast("long")
        parts = gone.select("digest", zero.alias("keep_id"), zero.alias("group_size"), zero.alias("keep_rows"), F.lit(1).alias("step")).unionByName(parts)
    if index is not None:
        parts = index.withColumn("step", F.lit(0)).unionByName(parts)
    n = partitions(spark, rows.count() + (index.count() if index is not None else 0), KEYS_PER_PARTITION)
    dealt = parts.repartition(n, "digest")
    if index is not None or deleted is not None:
        dealt = dealt.sortWithinPartitions("step")
    return dealt.mapInArrow(_index, ENTRY)


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, keep_id, group_size, keep_rows, kept. The largest id of a group stays."""
    rows = stored(digests(docs, id_col, text_col), "digests")
    index = stored(update_index(rows), "digest-index")
    return rows.join(index, "digest").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the row of the largest id of each group of equal texts, all columns as they were."""
    index = stored(update_index(stored(digests(docs, id_col, text_col), "digests")), "digest-index")
    return pick_rows(docs, id_col, digest_of(text_col), index.withColumnRenamed("digest", "key"))
