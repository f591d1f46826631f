"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the benchmark items form one automaton over word ids. A document's words are streamed through it;
the longest matching length at each word tells which windows (``window`` consecutive item words, or a whole shorter item)
end there, and the automaton's states tell in which items they occur. Words inside such occurrences are hits.

The items are the stated query set: they are taken in blocks of at most ``block_words`` words, each block is one automaton
that workers build from a broadcast of that size at most, and the documents pass through one block after the other.

Defined cases: a null text has no words; items without words never occur; a repeated item counts once; a null item id
reads as an empty string; documents keep all their columns and their number of rows, and an empty table gives an empty result. Very long texts are
streamed whole, one at a time. Where a span is cut out of a text, other columns, such as a length, stay as they were.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.common import fresh, utf8

WINDOW = 13
#: Words of the items in one automaton (about 1 KB each in a worker).
BLOCK_WORDS = 200_000
#: A document is contaminated when at least 1 / COVERAGE of its words are hit.
COVERAGE = 20

#: Byte table of the normalisation: A-Z become a-z, digits, letters and bytes above 7F stay, all others separate words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SPAN = "array<struct<start:int,end:int>>"
FOUND = f"n_words long, spans {SPAN}, item_ids array<string>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """All substrings of the items' word sequences; windows and their items by state."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, str, int]] = []
        self.short: dict[int, list[tuple[int, str]]] = {}
        owners: list[set[str]] = [set()]
        for item_id, text in items:
            state, n = 0, 0
            for w in words(text):
                n += 1
                state = self._extend(state, self.ids.setdefault(w, len(self.ids)))
                ends.append((state, item_id, n))
            if 0 < n < window:
                self.short.setdefault(state, []).append((n, item_id))
        owners = [set() for _ in self.next]
        for state, item_id, _ in ends:
            owners[state].add(item_id)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            owners[self.link[state]] |= owners[state]
        self._windows(owners)

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _state(self, length: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        twin = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[twin], self.link[q] = self.link[q], twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def _windows(self, owners: list[set[str]]) -> None:
        """Per state: the items that hold the full window ending in it, and the short items that end in it."""
        self.full: list[set[str] | None] = [None] * len(self.next)
        self.whole: list[list[tuple[int, str]]] = [[] for _ in self.next]
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            self.whole[state] = self.whole[up] + self.short.get(state, [])
            if self.length[state] >= self.window:
                self.full[state] = self.full[up] if self.length[up] >= self.window else owners[state]
        self.any = [bool(f or w) for f, w in zip(self.full, self.whole, strict=True)]

    def scan(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges [start, end), merged, and the items whose windows occur."""
        state = n = 0
        follow, link, length, any_ = self.next, self.link, self.length, self.any
        hits: list[tuple[int, int]] = []
        items: set[str] = set()
        for at, c in enumerate(map(self.ids.get, text)):
            if c is None:
                state = n = 0
                continue
            step = follow[state].get(c)
            if step is None:
                while state >= 0 and (step := follow[state].get(c)) is None:
                    state = link[state]
                if step is None:
                    state = n = 0
                    continue
                n = length[state]
            state, n = step, n + 1
            if any_[state]:
                if n >= self.window:
                    hits.append((at + 1 - self.window, at + 1))
                    items |= self.full[state]
                for k, item in self.whole[state]:
                    if k <= n:
                        hits.append((at + 1 - k, at + 1))
                        items.add(item)
        return merge_spans(hits), items


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of at most ``block_words`` words (a longer item is a block of its own)."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), utf8(F.col(text_col)).alias("text"))
    block, held = [], 0
    for row in rows.toLocalIterator():
        n = len(words(bytes(row.text)))
        if block and held + n > block_words:
            yield block
            block, held = [], 0
        if n:
            block.append((row.id, bytes(row.text)))
            held += n
    yield block


def annotate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    into: str = "found",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) and a struct ``into``: n_words, spans (merged hit word ranges), item_ids."""
    text = fresh("_bytes", docs)
    columns = docs.columns if keep is None else keep
    out = docs.select(*(F.col(f"`{c}`") for c in columns), utf8(F.col(f"`{text_col}`")).alias(text), F.lit(None).cast(f"struct<{FOUND}>").alias(into))
    for block in item_blocks(items, item_id, item_text, block_words):
        out = out.mapInArrow(_pass(docs.sparkSession.sparkContext.broadcast(block), text, into, window), out.schema)
    return out.drop(text)


def _pass(block, text_col: str, into: str, window: int):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("item_ids", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = SuffixAutomaton(block.value, window)
        for batch in batches:
            at = batch.schema.get_field_index(into)
            out = []
            for text, before in zip(batch.column(text_col), batch.column(at).to_pylist(), strict=True):
                found = words(text.as_py())
                spans, ids = automaton.scan(found)
                if before:
                    spans = merge_spans(spans + [(s["start"], s["end"]) for s in before["spans"]])
                    ids = ids | set(before["item_ids"])
                out.append({"n_words": len(found), "spans": [{"start": a, "end": b} for a, b in spans], "item_ids": sorted(ids)})
            columns = batch.columns
            columns[at] = pa.array(out, kind)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema.set(at, pa.field(into, kind)))

    return run


def n_hit(found: str = "found") -> Column:
    return F.aggregate(F.col(f"{found}.spans"), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated(found: str = "found", coverage: int = COVERAGE) -> Column:
    return (n_hit(found) > 0) & (n_hit(found) * coverage >= F.col(f"{found}.n_words"))


def remove_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", min_words: int = WINDOW, coverage: int = COVERAGE, **options) -> DataFrame:
    """``docs`` without contaminated rows; in the others, hit spans longer than ``min_words`` words are cut out of the text."""
    found = fresh("_found", docs)
    marked = annotate(docs, items, text_col, into=found, **options).filter(~contaminated(found, coverage))
    long_spans = F.filter(F.col(f"{found}.spans"), lambda s: s["end"] - s["start"] > min_words)
    marked = marked.withColumn(found, long_spans)
    return marked.mapInArrow(_cutting(text_col, found), marked.schema).select(*(F.col(f"`{c}`") for c in docs.columns))


def _cutting(text_col: str, found: str):
    """Cuts the spans out; batches without any, which are nearly all, go through as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(found)
            if len(spans.flatten()):
                at = batch.schema.get_field_index(text_col)
                texts = batch.column(at).to_pylist()
                for i, mine in enumerate(spans):
                    if len(mine):
                        texts[i] = _cut(texts[i], mine.as_py())
                columns = batch.columns
                columns[at] = pa.array(texts, batch.schema.field(at).type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return run


def _cut(text: str | None, spans) -> str | None:
    if text is None or not spans:
        return text
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw)]
    out, at = [], 0
    for s in spans:
        a, b = places[s["start"]][0], places[s["end"] - 1][1]
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]).decode()


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", coverage: int = COVERAGE, **options) -> DataFrame:
    """``docs`` without the rows whose hit share reaches the coverage limit; clean rows stay as they are."""
    found = fresh("_found", docs)
    marked = annotate(docs, items, text_col, into=found, **options)
    return marked.filter(~contaminated(found, coverage)).select(*(F.col(f"`{c}`") for c in docs.columns))
