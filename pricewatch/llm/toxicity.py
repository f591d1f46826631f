"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on the words that toxic documents over-use. A window (one
word inside a fixed frame, so that its own bytes decide) is compressed with each. The pair of lengths is the evidence: a
labelled sample calibrates how much more often each pair of lengths occurs in toxic documents, and a document's evidence is the
sum of the logarithms over its distinct windows that speak clearly for toxicity. The threshold is calibrated on the sample too
and lies at a score of ``ACCEPT``.

Labels are read from a bounded sample: about ``FIT_ROWS`` rows of each class at most, by a hash of their ids, up to
``FIT_BYTES`` of text. Everything else covers all rows and whole texts.

Defined cases: a null text counts as empty and scores like a text without evidence; without a toxic label in the sample all
scores are 0; rows are scored one by one, so repeats and extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.common import bounded_sample, fold, fresh, names, utf8

FIT_ROWS = 4_000
FIT_BYTES = 16_000_000
#: Folds of the documents; rows of fold HELD_OUT are never learned from.
FOLDS, HELD_OUT = 3, 1
ACCEPT = 0.7
ORDINARY_BYTES, TOXIC_BYTES = 100_000, 16_000
LEVEL = 3
#: A window's log ratio counts from here on; less is noise.
LEAST_EVIDENCE = 2.5
#: Over-used words: contexts at least, G-test value at least, and times the ordinary rate.
LEAST_CONTEXTS, LEAST_G, LEAST_LIFT = 5, 20.0, 8.0
LEAST_STEM = 4
#: Ordinary windows that every pair of lengths is taken to have had besides those seen.
PRIOR_WINDOWS = 3.0
#: Windows a worker remembers.
CACHE_WINDOWS = 400_000

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def windows(text: bytes) -> set[bytes]:
    return set(text.translate(_FOLD).split())


@dataclass
class Model:
    """Dictionaries, calibrated log ratios by (size, ordinary length, toxic length), and the threshold."""

    ordinary: bytes = b""
    toxic: bytes = b""
    frame: tuple[bytes, bytes] = (b"", b"")
    ratios: dict[tuple[int, int, int], float] = field(default_factory=dict)
    threshold: float = math.inf
    scale: float = 1.0

    def open(self) -> Model:
        """Set up the compressors; in the process that uses them."""
        kind = zstandard.DICT_TYPE_RAWCONTENT
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        # Raw content of under 8 bytes is no dictionary for zstandard.
        made = [zstandard.ZstdCompressionDict(c.rjust(8, b" "), dict_type=kind) for c in (self.ordinary, self.toxic)]
        self.compressors = [zstandard.ZstdCompressor(dict_data=d, **options) for d in made]
        self.cache: dict[bytes, float] = {}
        return self

    def lengths(self, window: bytes) -> tuple[int, int, int]:
        framed = self.frame[0] + b" " + window + b" " + self.frame[1]
        a, b = (len(c.compress(framed)) for c in self.compressors)
        return min(len(window), 24), a, b

    def window_evidence(self, window: bytes) -> float:
        found = self.cache.get(window)
        if found is None:
            if len(self.cache) >= CACHE_WINDOWS:
                self.cache.clear()
            ratio = self.ratios.get(self.lengths(window), 0.0)
            found = self.cache[window] = ratio if ratio >= LEAST_EVIDENCE else 0.0
        return found

    def evidence(self, text: bytes) -> float:
        return math.fsum(map(self.window_evidence, windows(text)))

    def score(self, text: bytes) -> float:
        if math.isinf(self.threshold):
            return 0.0
        x = (self.evidence(text) - self.threshold) / self.scale + math.log(ACCEPT / (1 - ACCEPT))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def _stems(word: bytes) -> list[bytes]:
    """The word, and its beginnings of four bytes and more (marked by a star)."""
    return [word, *(word[:n] + b"*" for n in range(LEAST_STEM, min(len(word), 10) + 1))]


def _contexts(texts: list[bytes]) -> Counter:
    """Distinct left neighbours of each word and stem: copies of a text add nothing."""
    pairs: set[tuple[bytes, bytes]] = set()
    for text in texts:
        found = text.translate(_FOLD).split()
        pairs.update(zip([b"", *found], found, strict=False))
    return Counter(stem for _, b in pairs for stem in _stems(b))


def overused(toxic: list[bytes], ordinary: list[bytes]) -> set[bytes]:
    """Words and stems whose contexts are significantly more in the toxic texts."""
    a, b = _contexts(toxic), _contexts(ordinary)
    na, nb = sum(a.values()) or 1, sum(b.values()) or 1
    out = set()
    for word, k in a.items():
        if k < LEAST_CONTEXTS:
            continue
        m = b[word]
        e, f = (k + m) * na / (na + nb), (k + m) * nb / (na + nb)
        g = 2 * (k * math.log(k / e) + (m * math.log(m / f) if m else 0.0))
        if g >= LEAST_G and k * nb >= LEAST_LIFT * na * (m + 0.5):
            out.add(word)
    return out


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary's content; of too few samples, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def fit(rows: list[tuple[bytes, int]]) -> Model:
    """A model of (text, label) rows: two thirds make the dictionaries and ratios, the threshold comes from the others."""
    toxic, ordinary = ([t for t, label in rows if label == k] for k in (1, 0))
    if not toxic or not ordinary:
        return Model().open()
    learned = [(t, k) for k, own in ((1, toxic), (0, ordinary)) for t in own[: -(-2 * len(own) // 3)]]
    words = overused(*([t for t, label in learned if label == k] for k in (1, 0)))
    samples = [b" ".join(w[i : i + 32]) for t in ordinary for w in [t.lower().split()] for i in range(0, len(w), 32)]
    speech = [b" " + b" ".join(w for w in t.translate(_FOLD).split() if words.intersection(_stems(w))) + b" " for t in toxic]
    plain = _dictionary(samples, ORDINARY_BYTES)
    frame = plain[-64:-24], plain[-24:]
    model = Model(plain, _dictionary([s for s in speech if s.strip()], TOXIC_BYTES) + frame[0] + frame[1], frame).open()
    counts = Counter(), Counter()
    seen: dict[bytes, tuple[int, int, int]] = {}
    for text, label in learned:
        for w in windows(text):
            if w not in seen:
                seen[w] = model.lengths(w)
            counts[label][seen[w]] += 1
    totals = [sum(c.values()) or 1 for c in counts]
    for key, k in counts[1].items():
        model.ratios[key] = math.log((k + 0.5) / totals[1] * totals[0] / (counts[0][key] + PRIOR_WINDOWS))
    return _calibrate(model, [r for k, own in ((1, toxic), (0, ordinary)) for r in zip(own[-(-2 * len(own) // 3) :] or own, [k] * len(own), strict=False)])


def _calibrate(model: Model, rows: list[tuple[bytes, int]]) -> Model:
    """The threshold with the fewest mistakes, in the middle between the neighbouring values of evidence."""
    found = sorted((model.evidence(text), label) for text, label in rows)
    wrong = best = sum(1 for _, label in found if label == 0)
    model.threshold = found[0][0] - 1
    for (e, label), (after, _) in zip(found, [*found[1:], (found[-1][0] + 2, 0)], strict=True):
        wrong += 1 if label else -1
        if after > e and wrong <= best:
            best, model.threshold = wrong, (e + after) / 2
    model.scale = max(0.25, abs(model.threshold) / 4)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> list[tuple[bytes, int]]:
    """About ``fit_rows`` rows of each class at most, outside the held-out fold, in the order of a hash of the id."""
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("fit_id"), F.col(f"`{label_col}`").cast("int").alias("label")).filter("fit_id is not null and label in (0, 1)")
    known = known.filter(fold(F.col("fit_id"), FOLDS) != HELD_OUT).withColumn("at", F.xxhash64("fit_id"))
    known = known.dropDuplicates(["fit_id", "label"])
    picked = [r for k in (0, 1) for r in bounded_sample(known.filter(F.col("label") == k), "fit_id", fit_rows).collect()]
    spark = docs.sparkSession
    chosen = spark.createDataFrame([(r.fit_id, r.label, r.at) for r in picked], "fit_id long, label int, at long")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("fit_id"), utf8(F.col(f"`{text_col}`")).alias("text"))
    rows, held = [], 0
    for r in texts.join(F.broadcast(chosen), "fit_id").orderBy("at", "fit_id").toLocalIterator():
        if held + len(r.text) <= FIT_BYTES:
            rows.append((bytes(r.text), r.label))
            held += len(r.text)
    return rows


def score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "toxicity", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the score in ``into``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.ordinary, model.toxic, model.frame, model.ratios, model.threshold, model.scale))
    text = fresh("_bytes", docs)
    columns = names(docs) if keep is None else [F.col(f"`{c}`") for c in keep]
    rows = docs.select(*columns, utf8(F.col(f"`{text_col}`")).alias(text))
    made = rows.drop(text).withColumn(into, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value).open()
        for batch in batches:
            scores = pa.array([own.score(t.as_py()) for t in batch.column(batch.num_columns - 1)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*batch.schema.names[:-1], into])

    return rows.mapInArrow(run, made)


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``ACCEPT`` or more."""
    into = fresh("_toxicity", docs)
    model = fit(labelled_sample(docs, labels, text_col=text_col))
    return score(docs, model, text_col, into).filter(F.col(into) < ACCEPT).select(*names(docs))
