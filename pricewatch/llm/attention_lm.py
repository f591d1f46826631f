"""Language-model scores from a causal self-attention model on subword ids, trained in numpy.

A text's words (A-Z lower-cased, one end token behind them) are split into subwords by the first ``PIECES`` ranks of a public
byte-pair vocabulary; the last subword of a word has an id of its own, so that a word's ids spell the word and where it ends.
For each id the model mixes two predictions by one softmax: attention over the window's earlier contexts, each pointing at the
id that followed it, and, behind a learned null key, the corpus's id-to-id frequencies inside words. Queries and keys are
learned projections of the last two ids. Windows of two blocks overlap by one block, so each id is scored once, with one to two
blocks of context, as batched masked matrix products. A word's probability is the mixture of its ids' product and its
frequency in the kind of text at hand, with a weight chosen on the training rows (each word's own occurrence left out). Kinds
are the signs of the first principal components of the documents' byte frequencies; how likely each is follows, word by word,
from the words before.

What the corpus gives covers all training rows: byte moments, word counts by kind, the id-to-id counts, and steps on every
run of words of each document; partitions train side by side and their parameters are averaged. Counts of
the ``KNOWN_WORDS`` most frequent words are broadcast (a bounded list); all other words' counts are joined by shuffle to the
documents that hold them before any is trained on or scored, so how long the list is does not change a score.

Defined cases: a null or empty text has only the end token; without training rows all counts are zero; rows are scored one by
one, so repeated ids and rows stay apart; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import math
import uuid
from collections.abc import Iterable, Iterator, Sequence
from itertools import batched, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.common import fold, stored, utf8
from pricewatch.session import new_dir

FOLDS, HELD_OUT = 10, 0
PIECES = 1024
KNOWN_WORDS = 200_000
#: Ids of a block; a window is two of them.
BLOCK = 16
DIM = 16
#: Words of a training run, runs of a gradient step, and texts that are split and whose unlisted words are held at once, or their bytes.
RUN_WORDS, STEP_RUNS, TEXTS_AT_ONCE, BYTES_AT_ONCE = 64, 64, 1000, 2_000_000
RATE = 0.05
WEIGHTS = (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)
#: Words by kind that are counted before a flush, and rows that are given to Spark at once.
CACHE_WORDS, ROWS_AT_ONCE = 300_000, 10_000
BLOCKS_AT_ONCE = 256
#: Words of the texts that are scored together.
WORDS_AT_ONCE = 10_000

END, PAD = 2 * PIECES, 2 * PIECES + 1
START = PAD
IDS = 2 * PIECES + 2
#: Principal components whose signs make the kinds of text, and the share of a kind's words taken from all text.
COMPONENTS, COMMON = 3, 0.02
KINDS = 1 << COMPONENTS
END_WORD = b" end"  # words hold no white space


def vocabulary_path() -> str:
    """The default vocabulary file; any file of lines ``base64 rank`` will do."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one behind the other, and how many each text has. Bytes that are no UTF-8 pass as they are."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string() if pa.types.is_binary(texts.type) else pa.large_string())))
    found, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy()
    if len(blank := np.flatnonzero(pc.equal(pc.binary_length(found), 0).to_numpy(zero_copy_only=False))):  # before or behind white space
        found = found.filter(pc.not_equal(pc.binary_length(found), 0))
        sizes = sizes - np.bincount(np.searchsorted(np.cumsum(sizes), blank, side="right"), minlength=len(sizes))
    return found.view(texts.type), sizes.astype(np.int64)


def pieces_of(batches: Iterable[pa.RecordBatch], share: int = 1) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``TEXTS_AT_ONCE`` texts and, but for single texts, ``BYTES_AT_ONCE`` bytes, or a share of those."""
    for batch in batches:
        ends, at = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(), dtype=np.int64), 0
        while at < batch.num_rows:
            most = (ends[at - 1] if at else 0) + BYTES_AT_ONCE // share
            n = min(max(1, int(np.searchsorted(ends, most, side="right")) - at), TEXTS_AT_ONCE)
            yield batch.slice(at, n)
            at += n


class Run:
    """Words ``begin`` to ``end`` of those found, their places in the list (its length for others), and the others."""

    def __init__(self, found: pa.Array, begin: int, end: int, places: np.ndarray, others: list[bytes]):
        self.found, self.begin, self.end, self.places, self.others = found, begin, end, places, others

    def __len__(self) -> int:
        return self.end - self.begin

    def __iter__(self) -> Iterator[bytes]:
        return iter(self.found.slice(self.begin, len(self)).to_pylist())


class Subwords:
    """Ids of words, as bytes of 16-bit numbers."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines) if int(b) < PIECES}
        self.bpe = tiktoken.Encoding("subwords", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.encode = self.bpe._core_bpe.encode_single_piece

    def of(self, word: bytes) -> bytes:
        return self.flat([word])[0].tobytes()

    def pieces(self, word: bytes) -> list[int]:
        """The ranks of a word's subwords; the end token's id less ``PIECES``."""
        if word == END_WORD:
            return [END - PIECES]
        # Long strings without white space are cut, as the merges of one piece take time with its square.
        return [i for at in range(0, len(word), 256) for i in self.encode(word[at : at + 256])]

    def flat(self, found: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one behind the other, and how many each has."""
        encode = self.encode
        parts = [encode(w) if len(w) <= 256 and w != END_WORD else self.pieces(w) for w in found]
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        ids = np.fromiter(chain.from_iterable(parts), dtype=np.int16, count=sizes.sum())
        ids[np.cumsum(sizes) - 1] += PIECES
        return ids, sizes


class Listed:
    """The listed words with their ids. All else that texts hold is spelt when it is met."""

    def __init__(self, path: str, found: list[bytes]):
        self.subwords, self.found = Subwords(path), pa.array(found, pa.binary())
        spelt = [self.subwords.flat(some) for some in batched(found, ROWS_AT_ONCE)] or [self.subwords.flat([])]
        self.ids, sizes = (np.concatenate(x) for x in zip(*spelt, strict=True))
        self.end = len(self.ids)
        #: With a last row for words that are not listed.
        self.sizes, self.begins = np.append(sizes, 0), np.append(np.cumsum(sizes) - sizes, self.end)
        self.text_end = np.array([found.index(END_WORD) if END_WORD in found else len(found)])

    def runs(self, texts: pa.Array, most: int | None = None) -> Iterator[Run]:
        """All words of all texts in runs of ``most`` words, else whole; a text without words is an empty run."""
        found, sizes = split(texts)
        places = pc.fill_null(pc.index_in(found, value_set=self.found.cast(found.type)), len(self.found)).to_numpy()
        at = np.flatnonzero(places == len(self.found))
        others = found.take(pa.array(at)).to_pylist()
        each = np.maximum(-(-sizes // most), 1) if most else np.ones_like(sizes)
        ends = np.repeat(np.cumsum(sizes), each)
        begins = ends - np.repeat(sizes, each) + (np.arange(len(ends)) - np.repeat(np.cumsum(each) - each, each)) * (most or 0)
        ends = np.minimum(ends, begins + most) if most else ends
        for begin, end, first, last in zip(*(x.tolist() for x in (begins, ends, np.searchsorted(at, begins), np.searchsorted(at, ends))), strict=True):
            yield Run(found, begin, end, places[begin:end], others[first:last])

    def streams(self, runs: Sequence[Run]) -> tuple[np.ndarray, dict[int, bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Of the runs' words and an end behind each: the places in the list (its length for others), the others by where they stand, all
        ids, where each word's begin, and the number of ids of each run."""
        places = np.concatenate([x for r in runs for x in (r.places, self.text_end)])
        run_ends = np.cumsum([len(r) + 1 for r in runs])
        own, source = self.sizes.take(places), self.begins.take(places)
        others = np.flatnonzero(places == len(self.found))
        ends = [END_WORD] if self.text_end[0] == len(self.found) else []
        words = [w for r in runs for w in chain(r.others, ends)]
        at: dict[bytes, int] = {}
        rows = [at.setdefault(w, len(at)) for w in words]
        more, sizes = self.subwords.flat(at)
        # Behind the listed words' ids, which stay, come those of the other words.
        if len(self.ids) < self.end + len(more):
            self.ids = np.concatenate([self.ids[: self.end], more, more])
        self.ids[self.end : self.end + len(more)] = more
        own[others], source[others] = sizes[rows], (np.cumsum(sizes) - sizes)[rows] + self.end
        begins = np.cumsum(own)
        total = int(begins[-1])
        begins -= own
        source -= begins
        taken = np.repeat(source, own)
        taken += np.arange(total)
        return places, dict(zip(others.tolist(), words, strict=True)), self.ids.take(taken), begins, np.add.reduceat(own, np.append(0, run_ends[:-1]))


_kept: dict[str, Listed] = {}


def listed(name: str, path: str, found: list[bytes]) -> Listed:
    """The list of that name; a worker keeps the last one from task to task."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = Listed(path, found)
    return _kept[name]


# ---- the model


def embedding() -> np.ndarray:
    """Fixed random codes of the ids; half of a context's numbers come from each of its two ids."""
    code = np.random.default_rng(7).standard_normal((IDS, DIM // 2)).astype(np.float32)
    return code / np.linalg.norm(code, axis=1, keepdims=True)


CODES = embedding()


def first_parameters() -> np.ndarray:
    """Query and key projections, recency bias by distance, and the null key's logit, in one vector."""
    same = np.eye(DIM, dtype=np.float64).ravel() * 2.0
    return np.concatenate([same, same, np.zeros(2 * BLOCK), [9.0]])


def _unpack(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    n = DIM * DIM
    return p[:n].reshape(DIM, DIM).astype(np.float32), p[n : 2 * n].reshape(DIM, DIM).astype(np.float32), p[2 * n : -1], float(p[-1])


_DISTANCE = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None, :]  # of a key from a query of the second block
_CAUSAL = _DISTANCE > 0
#: Logit of a key that may not be seen: far below the others, yet its exponential stays a normal number.
MASKED = -50.0


def lay_out(streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of several texts in blocks, each behind a block of padding, and the places of the ids."""
    return lay_out_flat(np.concatenate(streams), np.array([len(s) for s in streams])) if streams else lay_out_flat(np.empty(0, np.int16), np.empty(0, np.int64))


def lay_out_flat(stream: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`lay_out` of texts one behind the other, from the number of ids of each."""
    blocks = (-(-sizes // BLOCK) + 1) * BLOCK
    ids = np.full(blocks.sum(), PAD, dtype=np.int16)
    places = np.repeat(np.cumsum(blocks) - blocks + BLOCK - (np.cumsum(sizes) - sizes), sizes)
    places += np.arange(len(stream))
    ids[places] = stream
    return ids, places


def contexts(ids: np.ndarray) -> np.ndarray:
    """A row per id: the codes of the two ids before it."""
    one, two = _before(ids)
    return np.concatenate([CODES.take(one, axis=0), CODES.take(two, axis=0)], axis=1)


def _pairs(x: np.ndarray) -> np.ndarray:
    """Each block with the one before it, as a view: (blocks - 1) x 2 BLOCK x ..."""
    step = x.strides[0]
    return np.lib.stride_tricks.as_strided(x, (len(x) // BLOCK - 1, 2 * BLOCK, *x.shape[1:]), (step * BLOCK, step, *x.strides[1:]), writeable=False)


def _pairs_across(x: np.ndarray) -> np.ndarray:
    """The same of a matrix with a column per id: (blocks - 1) x rows x 2 BLOCK."""
    across, along = x.strides
    return np.lib.stride_tricks.as_strided(x, (x.shape[1] // BLOCK - 1, len(x), 2 * BLOCK), (along * BLOCK, across, along), writeable=False)


def _pair_bias(p: np.ndarray) -> tuple[np.ndarray, bool]:
    """The bias of each pair of places, and whether all logits are small enough to need no clipping."""
    wq, wk, bias, _ = _unpack(p)
    offset = np.where(_CAUSAL, bias[np.maximum(_DISTANCE, 0) % (2 * BLOCK)], MASKED).astype(np.float32)
    # A context is two unit vectors, so its length is at most the root of two; a matrix lengthens by at most the root of the product of its
    # largest column and row sums.
    longest = [math.sqrt(np.abs(w).sum(axis=0).max() * np.abs(w).sum(axis=1).max()) for w in (wq, wk)]
    return offset, 2 * longest[0] * longest[1] + float(bias.max()) < 80


def _before(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The id before each, and the one before that."""
    one = np.concatenate([[PAD], ids[:-1]])
    return one, np.concatenate([[PAD], one[:-1]])


def _weights(queries, keys_across, offset, values, small: bool) -> np.ndarray:
    """Exponentials of the logits; to the ids of a text, keys of the padding weigh nothing.

    Padding stands before a text's first block, and behind its last id, where no query sees it.
    """
    z = np.matmul(queries, keys_across)
    z += offset
    if not small:
        np.clip(z, -80.0, 80.0, out=z)
    np.exp(z, out=z)
    z[values[:, 0] == PAD, :, :BLOCK] = 0.0
    return z


def _equal(values: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Places, in (blocks, BLOCK, 2 BLOCK) laid flat, of the earlier keys that point at the query's own id; few do, so eight are passed over at
    once."""
    same = values[:, None, :] == np.where(targets == PAD, -1, targets)[:, :, None]
    same &= _CAUSAL
    same = same.reshape(-1, 8)
    some = np.flatnonzero(same.view(np.uint64) != 0)
    found = np.flatnonzero(same.take(some, axis=0))
    return (some.take(found >> 3) << 3) + (found & 7)


_ONES = np.ones(2 * BLOCK, dtype=np.float32)


def attend(p: np.ndarray, ids: np.ndarray, chunk: int = BLOCKS_AT_ONCE) -> tuple[np.ndarray, np.ndarray]:
    """Per id from the second block on: the attention's share of the id itself, and the null key's share."""
    wq, wk, _, _ = _unpack(p)
    offset, small = _pair_bias(p)
    c = contexts(ids)
    q, across, values = c @ wq, _pairs_across(wk.T @ c.T), _pairs(ids)
    queries, targets = q[BLOCK:].reshape(-1, BLOCK, DIM), ids[BLOCK:].reshape(-1, BLOCK)
    hit, total = np.empty(targets.size, np.float32), np.empty(targets.size, np.float32)
    for at in range(0, len(targets), chunk):
        part = slice(at, at + chunk)
        z = _weights(queries[part], across[part], offset, values[part], small).reshape(-1, 2 * BLOCK)
        ends = slice(at * BLOCK, at * BLOCK + len(z))
        total[ends] = z @ _ONES
        found = _equal(values[part], targets[part])
        hit[ends] = np.bincount(found // (2 * BLOCK), weights=z.ravel().take(found), minlength=len(z))
    e = np.float32(math.exp(min(p[-1], 80.0)))
    total += e
    return hit / total, e / total


def gradient(p: np.ndarray, ids: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, float, int]:
    """Gradient of the negative log-likelihood over ``ids``, the loss and the number of ids; ``inside``: their corpus share."""
    g, prob = step(p, ids, inside)
    prob = prob[ids[BLOCK:] != PAD]
    return g, float(-np.log(prob).sum()), len(prob)


def step(p: np.ndarray, ids: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gradient, and the probability of each id from the second block on."""
    c = contexts(ids)
    wq, wk, _, _ = _unpack(p)
    q, k, (offset, small) = c @ wq, c @ wk, _pair_bias(p)
    real = (ids[BLOCK:] != PAD).reshape(-1, BLOCK)
    keys, values = _pairs(k), _pairs(ids)
    queries, targets = q[BLOCK:].reshape(-1, BLOCK, DIM), ids[BLOCK:].reshape(-1, BLOCK)
    w = _weights(queries, _pairs_across(wk.T @ c.T), offset, values, small)
    e = math.exp(min(p[-1], 80.0))
    total = (w.reshape(-1, 2 * BLOCK) @ _ONES).reshape(real.shape) + np.float32(e)
    found = _equal(values, targets)
    row, hits = found // (2 * BLOCK), w.ravel().take(found)
    hit = np.bincount(row, weights=hits, minlength=real.size).reshape(real.shape)
    share = inside[BLOCK:].reshape(-1, BLOCK)
    prob = (hit + e * share) / total
    w.ravel()[found] = hits * (1 - 1 / prob.ravel().take(row)).astype(np.float32)
    w *= (real / total).astype(np.float32)[:, :, None]
    d_null = float(np.where(real, e / total * (1 - share / prob), 0.0).sum())
    dq = np.matmul(w, keys)
    dk_pairs = np.matmul(w.transpose(0, 2, 1), queries)
    # The projections' gradients side by side; the first block has no queries, the last block's keys are seen by one block only.
    d = np.empty((len(ids) // BLOCK, BLOCK, 2 * DIM), dtype=np.float32)
    d[0], d[1:, :, :DIM], d[1:, :, DIM:] = 0.0, dq, dk_pairs[:, BLOCK:]
    d[:-1, :, DIM:] += dk_pairs[:, :BLOCK]
    g = c.T @ d.reshape(-1, 2 * DIM)
    d_bias = np.bincount((np.maximum(_DISTANCE, 0) % (2 * BLOCK)).ravel(), weights=w.sum(axis=0).ravel(), minlength=2 * BLOCK)
    return np.concatenate([g[:, :DIM].ravel(), g[:, DIM:].ravel(), d_bias, [d_null]]), prob.ravel()


def inside_words(ids: np.ndarray, begins: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The corpus share of each id behind the one before it in its word."""
    before = np.concatenate([[START], ids[:-1]])
    before[begins] = START
    before *= IDS
    before += ids
    return table.ravel().take(before)


def shares(counts: np.ndarray) -> np.ndarray:
    """Smoothed id-to-id shares of counts (IDS x IDS), the rows summing to one."""
    total = counts.sum(axis=0) + 0.5
    back = total / total.sum()
    rows = counts.sum(axis=1, keepdims=True)
    kinds = (counts > 0).sum(axis=1, keepdims=True) + 1.0
    return ((counts + kinds * back) / (rows + kinds)).astype(np.float32)


# ---- on Spark


def profile(text: bytes) -> np.ndarray:
    """Square roots of the shares of the bytes."""
    return np.sqrt(np.bincount(np.frombuffer(text.lower(), dtype=np.uint8), minlength=256) / max(1, len(text)))


def axes(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean profile and first principal components over all rows; 256 x 256 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, one, two = 0, np.zeros(256), np.zeros((256, 256))
        for batch in batches:
            x = np.array([profile(t.as_py()) for t in batch.column("text")]).reshape(-1, 256)
            n, one, two = n + len(x), one + x.sum(axis=0), two + x.T @ x
        values = np.concatenate([[n], one, two.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["i", "v"])

    rows = texts.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    values = np.zeros(1 + 256 + 256 * 256)
    values[rows.column("i").to_numpy()] = rows.column("v").to_numpy()
    n = max(values[0], 1.0)
    mean = values[1:257] / n
    _, vectors = np.linalg.eigh(values[257:].reshape(256, 256) / n - np.outer(mean, mean))
    return mean, vectors[:, ::-1][:, :COMPONENTS]


def kind(text: bytes, mean: np.ndarray, vectors: np.ndarray) -> int:
    return int(((profile(text) - mean) @ vectors > 0) @ (1 << np.arange(COMPONENTS)))


def word_counts(texts: DataFrame, mean: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """(word, n, kinds: n in each kind of text) over all rows; the end token has a word of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in pieces_of(batches, 2):
            found, sizes = split(batch.column("text"))
            own = np.array([kind(t.as_py(), mean, vectors) for t in batch.column("text")], dtype=np.int32)
            counted = pa.table({"word": found.cast(pa.binary()), "kind": np.repeat(own, sizes)}).group_by(["word", "kind"], use_threads=False).aggregate([([], "count_all")])
            held.append(counted.rename_columns({"count_all": "n"}))
            texts_each = np.bincount(own, minlength=KINDS)
            held.append(pa.table({"word": pa.array([END_WORD] * KINDS, pa.binary()), "kind": np.arange(KINDS, dtype=np.int32), "n": texts_each}).filter(pa.array(texts_each > 0)))
            if sum(t.num_rows for t in held) > CACHE_WORDS:
                held = [_summed(held)]
                if held[0].num_rows > CACHE_WORDS * 3 // 4:
                    yield from held.pop().to_batches(ROWS_AT_ONCE)
        if held:
            yield from _summed(held).to_batches(ROWS_AT_ONCE)
        held.clear()
        pa.default_memory_pool().release_unused()

    rows = texts.mapInArrow(run, "word binary, kind int, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"), *(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"k{k}") for k in range(KINDS)))


def _summed(counted: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(counted).group_by(["word", "kind"], use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})


def id_counts(counts: DataFrame, path: str) -> np.ndarray:
    """Id-to-id counts inside words; at most IDS x IDS numbers reach the driver, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords, table = Subwords(path), np.zeros((IDS, IDS))
        for batch in batches:
            ids, sizes = subwords.flat(batch.column("word").to_pylist())
            before = np.concatenate([[START], ids[:-1]]).astype(np.int64)
            before[np.cumsum(sizes) - sizes] = START
            np.add.at(table.ravel(), before[: len(ids)] * IDS + ids, np.repeat(batch.column("n").to_numpy(), sizes))
        a, b = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(a * IDS + b), pa.array(table[a, b].astype(np.int64))], names=["at", "n"])

    rows = counts.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(IDS * IDS)
    table[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    return table.reshape(IDS, IDS)


class Scorer:
    """All that a worker needs to train on texts or score them."""

    def __init__(self, name: str, path: str, known: tuple[list[bytes], np.ndarray], by_kind: np.ndarray, distinct: int, table: np.ndarray, p: np.ndarray, weight: float):
        self.listed, self.table, self.p, self.weight = listed(name, path, known[0]), table, p, weight
        #: Words of each kind of text in the whole corpus.
        self.by_kind, self.total, self.distinct = by_kind, int(by_kind.sum()), distinct
        self.prior = (by_kind + 1) / (by_kind.sum() + KINDS)
        #: The last row is for words without a count.
        kinds = np.vstack([np.asarray(known[1], dtype=np.float64).reshape(-1, KINDS), np.zeros(KINDS)])
        self.counts, self.rows = kinds.sum(axis=1), self.shares_of(kinds)
        self.rows[-1, :KINDS] = 0.0

    def shares_of(self, kinds: np.ndarray) -> np.ndarray:
        """Logarithms and values of words' shares by kind from their counts, side by side, so that a word is looked up once."""
        shared = kinds.sum(axis=1) / max(self.total, 1)
        out = np.empty((len(kinds), 2 * KINDS))
        logs, values = out[:, :KINDS], out[:, KINDS:]
        np.multiply(kinds, 1 - COMMON, out=values)
        values /= np.maximum(self.by_kind, 1)
        values += COMMON * shared[:, None]
        np.log(np.add(values, 1e-300, out=logs), out=logs)
        return out

    def unlisted(self, others: Iterable[tuple[list[bytes], np.ndarray]]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
        """Places, shares and counts of the words outside the list that texts hold, from these words and their counts by kind."""
        at: dict[bytes, int] = {}
        parts = [(w, c) for w, c in others if w]
        rows = [at.setdefault(w, len(at)) for w in chain.from_iterable(w for w, _ in parts)]
        kinds = np.empty((len(at), KINDS))
        if parts:
            kinds[rows] = np.concatenate([c for _, c in parts])
        return at, self.shares_of(kinds), kinds.sum(axis=1)

    def look_up(self, places: np.ndarray, found: dict[int, bytes], others: tuple[dict[bytes, int], np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Shares and count of each word; ``found``: of :meth:`Listed.streams`, ``others``: of :meth:`unlisted`."""
        rows, counts = self.rows.take(places, axis=0), self.counts.take(places)
        at, shared, each = others
        if at:
            unlisted, own = np.array(list(found), dtype=np.int64), np.array([at.get(w, -1) for w in found.values()], dtype=np.int64)
            unlisted, own = unlisted[own >= 0], own[own >= 0]
            rows[unlisted], counts[unlisted] = shared[own], each[own]
        return rows, counts

    def own_share(self, rows: np.ndarray, counts: np.ndarray, sizes: list[int], left_out: int = 0) -> np.ndarray:
        """Probability of each word by the kinds' frequencies, the kinds weighed by the words before it in its text."""
        # A row per kind, so that maxima and sums run over whole rows.
        rows = np.ascontiguousarray(rows.T)
        logs, values = rows[:KINDS], rows[KINDS:]
        begins = np.cumsum(sizes) - sizes
        before = np.cumsum(logs, axis=1)
        before -= logs
        before -= np.repeat(before[:, begins] - np.log(self.prior)[:, None], sizes, axis=1)
        before -= before.max(axis=0)
        np.exp(before, out=before)
        before *= (1 - COMMON) / before.sum(axis=0)
        before += COMMON * self.prior[:, None]
        before *= values
        out = before.sum(axis=0)
        if not left_out:
            return out
        return out * np.maximum(counts - left_out, 0) / np.maximum(counts, 1)

    def word_log(self, stream: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """log P of each word of the texts' ids under the attention model."""
        ids, places = lay_out_flat(stream, sizes)
        hit, null = attend(self.p, ids)
        at = places - BLOCK
        logs = np.log(hit.take(at) + null.take(at) * inside_words(stream, begins, self.table) + 1e-30, dtype=np.float64)
        return np.add.reduceat(logs, begins)


def _unlisted(share):
    """The distinct words of each text that are not in the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(share.value, pa.binary())
        for batch in pieces_of(batches):
            found, sizes = split(batch.column("text"))
            other = np.flatnonzero(pc.is_null(pc.index_in(found, value_set=known.cast(found.type))).to_numpy(zero_copy_only=False))
            text = np.searchsorted(np.cumsum(sizes), other, side="right")
            pairs = dict.fromkeys(zip(batch.column("uid").to_numpy()[text].tolist(), found.take(pa.array(other)).to_pylist(), strict=True))
            yield _word_batch([u for u, _ in pairs], [w for _, w in pairs])
        pa.default_memory_pool().release_unused()

    return run


def _word_batch(uids: list[int], found: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(found, pa.binary())], names=["uid", "word"])


def with_unlisted(rows: DataFrame, by_kind: DataFrame, share) -> DataFrame:
    """``rows`` (uid, text, ...) with the counted words of each text outside the list, and their counts by kind.

    Rows of one uid get the words of all of them, so equal rows or a collision change no score.
    """
    kinds = [f"k{k}" for k in range(KINDS)]
    found = rows.select("uid", "text").mapInArrow(_unlisted(share), "uid long, word binary").join(by_kind, "word")
    found = found.groupBy("uid").agg(F.collect_list(F.struct("word", F.array(*kinds).alias("kinds"))).alias("r"))
    found = found.select("uid", F.col("r.word").alias("others"), F.flatten("r.kinds").alias("other_counts"))
    out, path = rows.join(found, "uid", "left").drop("uid"), new_dir(rows.sparkSession, "lm-texts")
    out.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(out.schema).parquet(path)


def _others(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The words of each text that are not in the list, and their counts by kind."""
    column = batch.column("others")
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64).tolist()
    found = column.flatten().to_numpy(zero_copy_only=False).tolist()
    counts = batch.column("other_counts").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, KINDS)
    for begin, end in pairwise(chain((0,), ends)):
        yield found[begin:end], counts[begin:end]


def _train(share):
    """Local gradient steps over all runs of a partition; gives the parameters times the steps, the steps, and the weights' losses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(*share.value)
        memory, steps, losses = np.zeros_like(s.p), 0, np.zeros(len(WEIGHTS))
        for batch in (b.slice(at, TEXTS_AT_ONCE) for b in batches for at in range(0, b.num_rows, TEXTS_AT_ONCE)):
            others = s.unlisted(_others(batch))
            for part in batched((r for piece in pieces_of([batch]) for r in s.listed.runs(piece.column("text"), RUN_WORDS)), STEP_RUNS):
                known, found, stream, begins, sizes = s.listed.streams(part)
                ids, places = lay_out_flat(stream, sizes)
                inside = np.ones(len(ids))
                inside[places] = inside_words(stream, begins, s.table)
                g, prob = step(s.p, ids, inside)
                g /= len(stream)
                memory += g * g
                logs = np.exp(np.add.reduceat(np.log(prob[places - BLOCK] + 1e-30), begins))
                own = s.own_share(*s.look_up(known, found, others), [len(r) + 1 for r in part], 1)
                losses += [-np.log((1 - w) * own + w * logs + 1e-300).sum() for w in WEIGHTS]
                s.p = s.p - RATE * g / (np.sqrt(memory) + 1e-8)
                steps += 1
        pa.default_memory_pool().release_unused()
        values = np.concatenate([s.p * steps, [steps], losses])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["i", "v"])

    return run


ROW = "doc_id long, held_out boolean, n_tokens long, base_score double, n_known long, score double"


def _score(share):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(*share.value)
        floor = s.total + 0.1 * (s.distinct + 1)
        for batch in pieces_of(batches):
            rows, held, others, size = [], [], [], 0
            for run, other in zip(s.listed.runs(batch.column("text")), _others(batch), strict=True):
                held.append(run)
                others.append(other)
                size += len(run)
                if size > WORDS_AT_ONCE:
                    rows += _scored(s, held, others, floor)
                    held, others, size = [], [], 0
            if held:
                rows += _scored(s, held, others, floor)
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.float64(), pa.int64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *columns], names=[f.split()[0] for f in ROW.split(", ")])
        pa.default_memory_pool().release_unused()

    return run


def _scored(s: Scorer, texts: list[Run], others: list[tuple[list[bytes], np.ndarray]], floor: float) -> list[tuple]:
    """(n_tokens, base, counted words, score) of each text."""
    places, found, stream, begins, ids_each = s.listed.streams(texts)
    logs = s.word_log(stream, begins, ids_each)
    rows, counts = s.look_up(places, found, s.unlisted(others))
    sizes = [len(t) + 1 for t in texts]
    begins = np.cumsum(sizes) - sizes
    mixed = np.log10((1 - s.weight) * s.own_share(rows, counts, sizes) + s.weight * np.exp(logs) + 1e-300)
    base = np.log10((counts + 0.1) / floor)
    sums = [np.add.reduceat(x, begins).tolist() for x in (base, (counts > 0).astype(np.int64), mixed)]
    return list(zip(sizes, *sums, strict=True))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``."""
    spark, path = docs.sparkSession, path or vocabulary_path()
    held_out = (fold(F.col(f"`{id_col}`"), FOLDS) == HELD_OUT).alias("held_out")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), held_out, utf8(F.col(f"`{text_col}`")).alias("text"))
    rows = rows.withColumn("uid", F.xxhash64("doc_id", "text"))
    training = rows.filter(~F.col("held_out")).select("text")
    by_kind = stored(word_counts(training, *axes(training)), "word-counts")
    counts = by_kind.select("word", "n")
    names = [f"k{k}" for k in range(KINDS)]
    sums = by_kind.agg(F.count(F.lit(1)).alias("v"), *(F.sum(c).alias(c) for c in names)).first()
    kinds, distinct = np.array([sums[c] or 0 for c in names], dtype=np.float64), sums.v
    # The list ends at the lowest count that keeps it within its bound, found from how many words have each count.
    listed, floor = 1, 1 << 62
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.col("n").desc()).toLocalIterator():
        listed += r.words
        if listed > KNOWN_WORDS:
            break
        floor = r.n
    top = by_kind.filter((F.col("n") >= floor) | (F.col("word") == F.lit(END_WORD))).toArrow()
    # Frequent words first, so that what belongs to them lies close together.
    top = top.sort_by([("n", "descending"), ("word", "ascending")])
    known = top.column("word").to_pylist(), np.stack([top.column(c).to_numpy() for c in names], axis=1)
    table = shares(id_counts(counts, path))
    p, weight = first_parameters(), 0.3
    names_only = spark.sparkContext.broadcast(known[0])
    rows = with_unlisted(rows, by_kind.drop("n"), names_only)
    names_only.unpersist()
    training = rows.filter(~F.col("held_out")).select("text", "others", "other_counts")
    name = uuid.uuid4().hex
    share = spark.sparkContext.broadcast((name, path, known, kinds, distinct, table, p, weight))
    sums = {r.i: r.v for r in training.mapInArrow(_train(share), "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    if steps := sums.get(len(p), 0):
        p = np.array([sums[i] / steps for i in range(len(p))])
        weight = min(zip([sums[len(p) + 1 + i] for i in range(len(WEIGHTS))], WEIGHTS, strict=True))[1]
    share.unpersist()
    share = spark.sparkContext.broadcast((name, path, known, kinds, distinct, table, p, weight))
    made = stored(rows.mapInArrow(_score(share), ROW), "lm-scores")
    return made.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(kinds.sum())).cast("long").alias("train_tokens"), "base_score", "score")
