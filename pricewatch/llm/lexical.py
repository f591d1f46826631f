"""Ranked lexical search over blocked posting lists.

A document's weight for a term, its impact, is a whole number, and its score for an item is the sum over the item's terms. Items are the
stated query set; they are taken in blocks of at most about ``TERMS`` terms, and every document is indexed for each block.

1. :func:`vectors` reads every whole text once: its number of terms and how often each of the block's terms occurs in it.
2. Counts over all documents (documents, terms, documents per term) give the weights; per term they are as many as the block has terms.
3. :class:`Index` takes some thousand documents at a time. Each term's posting list is clustered by similarity: documents in it are
   compared with some of its own documents, and join the one with the greatest inner product. Each cluster is a block with a summary, the
   largest impact of any of its documents, coordinate by coordinate. A summary has the coordinates that items with the term use.
4. A block is read for an item only if the summary's sum over the item's terms, which no document in it exceeds, can still enter the
   item's best ``k``. Blocks come by falling bound and the least score to beat rises meanwhile, also from one group of documents of a task to
   the next. Nothing else is ever skipped, so results are exact.
5. Spark ranks what the tasks found, first per item and salt, then per item.

A document with a score above 0 has a term of the item, hence stands in a posting list that the item reads. Each group's index is built
where it is searched and is not written: its blocks together are some times larger than the documents.

Defined cases: a null or empty text and one without terms is not counted and not found; an item without terms has no rows, and neither has
anything if a table is empty. Null ids of documents rank after all others of the score. Rows of the same id are documents of their own. Items
that repeat an id are one item with the terms of all of them; a null item id is an id. Terms of weight 0 add nothing. Long texts are read
whole, one at a time. Columns other than the ids and texts are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricewatch.llm.common import stored, utf8

BEST = 50
#: Terms (counted once per item) of one block of items, on average: bounds what is broadcast and the width of a group.
TERMS = 8192
#: Documents indexed at a time and numbers held for them at most, documents to a block of a posting list on average.
GROUP, CELLS, BLOCK = 2048, 1 << 24, 32
SALTS = 32
#: Weights of the formula: whole numbers, divisions round down.
_UNIT, _FLAT, _SLOPE = 1_000_000_000, 50, 50
_LAST = (1 << 63) - 1

_SEPARATE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of digits, letters and bytes beyond ASCII, A-Z in lower case."""
    return text.translate(_SEPARATE).split()


# ---- corpus


def vectors(docs: DataFrame, number: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms with repeats), term, tf (the block's terms in the document) of every document that has a term."""
    sent = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            ids, sizes, found = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                here = terms(text.as_py())
                if here:
                    ids.append(doc_id)
                    sizes.append(len(here))
                    found.append(sorted((known[t], c) for t, c in Counter(here).items() if t in known))
            lists = [pa.array([[x[i] for x in f] for f in found], pa.list_(pa.int32() if i == 0 else pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "term", "tf"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), utf8(F.col(f"`{text_col}`")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, term array<int>, tf array<long>")


def holders(docs: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of the block's terms; every task counts its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, dtype=np.int64)
        for batch in batches:
            df += np.bincount(batch.column("term").flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["t", "df"])

    out = np.zeros(size, dtype=np.int64)
    for r in docs.select("term").mapInArrow(run, "t int, df long").groupBy("t").agg(F.sum("df").alias("df")).collect():
        out[r.t] = r.df
    return out


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1).astype(np.float64))).astype(np.int64)


def impacts(term: np.ndarray, tf: np.ndarray, n: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The impact of each (term, count) in a document of ``n`` terms."""
    m = 100 - _FLAT + (_SLOPE * n * n_docs) // n_terms
    return weight[term] * ((_UNIT * tf) // (1000 * tf + 20 * m))


# ---- index and search of a group of documents


class Queries:
    """The items of a block: their terms, and for each term the items that have it and all terms of those."""

    def __init__(self, items: list[list[int]], weight: np.ndarray):
        self.items = [np.array([t for t in sorted(set(i)) if weight[t] > 0], dtype=np.int64) for i in items]
        having: dict[int, list[int]] = {}
        for q, i in enumerate(self.items):
            for t in i:
                having.setdefault(int(t), []).append(q)
        #: Rare terms first: their documents score high and raise what others have to beat.
        self.terms = []
        for t in sorted(having, key=lambda t: (-weight[t], t)):
            coords = np.unique(np.concatenate([self.items[q] for q in having[t]]))
            self.terms.append((t, coords, [(q, np.searchsorted(coords, self.items[q])) for q in having[t]]))


class Index:
    """Posting lists of a group of documents, each cut into blocks of similar documents with summaries."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, size: int):
        order = np.lexsort((doc, term))
        self.docs, bounds = doc[order], np.searchsorted(term[order], np.arange(size + 1))
        self.lists = [self.docs[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        self.forward = np.zeros((n_docs, size), dtype=np.int64)
        self.forward[doc, term] = impact

    def blocks(self, t: int, coords: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents in the order of blocks, their rows of ``coords``, start of each block, summaries)."""
        posting = self.lists[t]
        rows = self.forward[posting[:, None], coords]
        if len(posting) > BLOCK:
            near = rows.astype(np.float32)
            seeds = near[:: BLOCK]
            seeds = seeds / np.sqrt((seeds * seeds).sum(axis=1, keepdims=True) + 1)
            cluster = (near @ seeds.T).argmax(axis=1)
            order = np.argsort(cluster, kind="stable")
            start = np.flatnonzero(np.diff(cluster[order], prepend=-1))
        else:
            order, start = np.arange(len(posting)), np.zeros(1, dtype=np.int64)
        rows = rows[order]
        return posting[order], rows, start, np.maximum.reduceat(rows, start, axis=0)


class Best:
    """The ``k`` best (score, id) of each item so far, and the least score that can still enter."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score, self.doc = [np.empty(0, dtype=np.int64)] * items, [np.empty(0, dtype=np.int64)] * items

    def least(self, q: int) -> int:
        return int(self.score[q][-1]) if len(self.score[q]) == self.k else 1

    def add(self, q: int, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.r_[self.score[q], score], np.r_[self.doc[q], doc]
        order = np.lexsort((doc, -score))[: self.k]
        self.score[q], self.doc[q] = score[order], doc[order]


def search(index: Index, ids: np.ndarray, queries: Queries, held: Best) -> tuple[int, int]:
    """All documents of the index that enter an item's best; (blocks read, blocks skipped)."""
    seen = np.zeros((len(queries.items), len(ids)), dtype=bool)
    read = skipped = 0
    for t, coords, asked in queries.terms:
        if not len(index.lists[t]):
            continue
        posting, rows, start, summary = index.blocks(t, coords)
        end = np.r_[start[1:], len(posting)]
        for q, cols in asked:
            bound = summary[:, cols].sum(axis=1)
            order = np.argsort(-bound, kind="stable")
            at = 0
            while at < len(order) and bound[order[at]] >= held.least(q):
                # Doubling: the best block alone first, then more at a time.
                some = order[at : 2 * at + 1]
                some = some[bound[some] >= held.least(q)]
                at = 2 * at + 1
                read += len(some)
                row = np.concatenate([np.arange(start[b], end[b]) for b in some])
                row = row[~seen[q, posting[row]]]
                seen[q, posting[row]] = True
                score = rows[row[:, None], cols].sum(axis=1)
                ok = score >= held.least(q)
                if ok.any():
                    held.add(q, score[ok], ids[posting[row[ok]]])
            skipped += max(0, len(order) - at)
    return read, skipped


def _group(batch: pa.Table, weight: np.ndarray, n_docs: int, n_terms: int) -> tuple[np.ndarray, Index]:
    batch = batch.combine_chunks()
    ids = batch.column("doc_id").fill_null(_LAST).to_numpy()
    lists = batch.column("term").combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(ids)), lengths)
    term, tf = lists.flatten().to_numpy().astype(np.int64), batch.column("tf").combine_chunks().flatten().to_numpy()
    impact = impacts(term, tf, np.repeat(batch.column("n").to_numpy(), lengths), weight, n_docs, n_terms)
    return ids, Index(doc, term, impact, len(ids), len(weight))


def _groups(batches: Iterator[pa.RecordBatch], terms: int) -> Iterator[pa.Table]:
    """Whole groups of documents, and a last one."""
    size, held, n = max(1, min(GROUP, CELLS // terms)), [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            held.append(part)
            n += part.num_rows
            if n >= size:
                both = pa.Table.from_batches(held)
                yield both.slice(0, size)
                held, n = both.slice(size).to_batches(), n - size
    if n:
        yield pa.Table.from_batches(held)


def search_block(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], k: int, id_col: str, text_col: str) -> DataFrame:
    """item (place in the list), doc_id, score: the best ``k`` of each task, for the items of one block."""
    spark = docs.sparkSession
    number = {t: i for i, t in enumerate(sorted({t for _, ts in items for t in ts}))}
    found = stored(vectors(docs, number, id_col, text_col), "term-vectors")
    n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = weights(holders(found, len(number)), n_docs)
    sent = spark.sparkContext.broadcast((weight, [[number[t] for t in ts] for _, ts in items]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, asked = sent.value
        queries, held = Queries(asked, weight), Best(len(asked), k)
        for group in _groups(batches, len(weight)):
            ids, index = _group(group, weight, n_docs, n_terms)
            search(index, ids, queries, held)
        for q in range(len(asked)):
            yield pa.RecordBatch.from_arrays([pa.array([q] * len(held.doc[q]), pa.int32()), pa.array(held.doc[q]), pa.array(held.score[q])], names=["item", "doc_id", "score"])

    return found.filter(F.size("term") > 0).mapInArrow(run, "item int, doc_id long, score long")


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, term: each item's terms, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, t) for i, x in zip(batch.column("item_id").to_pylist(), batch.column("text"), strict=True) for t in set(terms(x.as_py()))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["item_id", "term"])

    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), utf8(F.col(f"`{text_col}`")).alias("text"))
    return rows.mapInArrow(run, "item_id long, term binary").distinct()


def rank(docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    asked = stored(item_terms(items, item_col, text_col), "item-terms")
    blocks = -(-asked.count() // TERMS)
    out = empty(spark)
    for b in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).groupBy("item_id").agg(F.collect_list("term").alias("terms"))
        items_here = sorted(((r.item_id, sorted(map(bytes, r.terms))) for r in mine.collect()), key=lambda x: (x[0] is None, x[0] or 0))
        if not items_here:
            continue
        found = search_block(docs, items_here, k, id_col, text_col)
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(items_here)], "item int, item_id long")
        out = out.union(stored(_ranked(found, k), "ranked").join(names, "item").select("item_id", "rank", F.nullif("doc_id", F.lit(_LAST)).alias("doc_id"), "score"))
    return out


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Ranks in two steps, so that no task reads what all others found for an item."""
    order = (F.desc("score"), "doc_id")
    some = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
