"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A logistic model of a few text measures, fitted on a bounded labelled sample, gives each document's own evidence. Per path and
host the evidence of all documents (a training label where there is one) is summed; a path's posterior is shrunk towards its
host's, a host's towards the global mean, each with the strength that the spread between sites supports (method of moments).
The score adds the path posterior's log odds, relative to the global ones, to the document's own.

Host and path are columns; the documents at hand have a source as host and a language as the path below it.

Defined cases: a null or empty text has all measures zero; null hosts and paths are sites of their own; without both labels in
the sample the model is flat and every document scores one half; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.common import bounded_sample, fold, stored, utf8

#: Labelled rows of each class that the classifier is fitted on, at most (about).
FIT_ROWS = 5_000
FOLDS, HELD_OUT = 3, 1
KEEP = 0.5
RIDGE, ROUNDS = 1e-2, 25

_KIND = np.zeros(256, dtype=np.int64)  # 0 other, 1 lower or non-ASCII letter, 2 upper, 3 digit, 4 space, 5 sentence mark, 6 symbol
_KIND[33:127] = 6
_KIND[97:123] = 1
_KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[[ord(c) for c in ".,;:?'\"-()"]] = 5
MEASURES = ("upper", "digit", "mark", "symbol", "word_bytes", "distinct", "echo", "words")


def measures(text: bytes) -> list[float]:
    """Shares of kinds of bytes, mean word length, distinct words, words equal to the one before, and the log of the words."""
    found = text.split()
    if not found:
        return [0.0] * len(MEASURES)
    kinds = np.bincount(_KIND[np.frombuffer(text, dtype=np.uint8)], minlength=7)
    n, letters = len(found), max(1, int(kinds[1] + kinds[2]))
    echo = sum(map(bytes.__eq__, found, found[1:])) / n
    return [
        float(kinds[2] / letters),
        float(kinds[3] / len(text)),
        float(kinds[5] / n),
        float(min(kinds[6] / n, 3.0)),
        min(len(text) / n, 30.0) / 10,
        len(set(found)) / n**0.8,
        echo,
        float(np.log1p(n)) / 5,
    ]


@dataclass
class Logistic:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    @staticmethod
    def _inputs(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
        z = np.clip((x - mean) / spread, -8, 8)
        return np.hstack([np.ones((len(z), 1)), z, z * z])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._inputs(x, self.mean, self.spread) @ self.weights, -12, 12)


def fit(x: np.ndarray, y: np.ndarray) -> Logistic:
    """Ridge logistic regression by Newton steps; flat if a class is missing."""
    k = len(MEASURES)
    if len(set(y.tolist())) < 2:
        return Logistic(np.zeros(k), np.ones(k), np.zeros(2 * k + 1))
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z, w = Logistic._inputs(x, mean, spread), np.zeros(2 * k + 1)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z / len(z) + RIDGE * np.eye(len(w))
        w = w - np.linalg.solve(h, z.T @ (p - y) / len(z) + RIDGE * w)
    return Logistic(mean, spread, w)


def measured(docs: DataFrame, id_col: str, text_col: str, host: Column, path: Column) -> DataFrame:
    """doc_id, host, path, x (the measures) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([measures(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], x], names=["doc_id", "host", "path", "x"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), utf8(F.col(f"`{text_col}`")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, host string, path string, x array<double>")


def _sample(rows: DataFrame, fit_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Measures and labels of about ``fit_rows`` training rows of each class at most, in the order of the id."""
    picked = [r for k in (0, 1) for r in bounded_sample(rows.filter(F.col("label") == k), "doc_id", fit_rows).select("doc_id", "x", "label").collect()]
    picked.sort(key=lambda r: (r.label, r.doc_id, r.x))
    return np.array([r.x for r in picked]).reshape(-1, len(MEASURES)), np.array([r.label for r in picked], dtype=float)


def shrink(sites: DataFrame, total: Column, n: Column, prior: Column) -> Column:
    """A site's posterior mean: its total of ``n`` pulled to the prior by as many pseudo-rows as the spread supports."""
    return (total + F.col("strength") * prior) / (n + F.col("strength"))


def strength(sites: DataFrame, mean: Column) -> float:
    """Pseudo-rows of the prior by the method of moments: within-site variance over what the sites' means vary beyond it."""
    within = mean * (1 - mean)
    r = sites.agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - mean, 2)).alias("q"),
        F.sum(within).alias("e"),
        F.sum(F.col("n") * within).alias("w"),
        F.sum("n").alias("n"),
        (F.sum("n") - F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("c"),
    ).first()
    if not r.n or not r.c or r.c <= 0:
        return 10.0
    between = max((r.q - r.e) / r.c, 1e-6)
    return float(min(max((r.w / r.n) / between, 1.0), 1e6))


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, host, path, own (the text's probability), host_posterior, path_posterior, score for every row."""
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("k_id"), F.col(f"`{label_col}`").cast("int").alias("label")).filter("k_id is not null and label in (0, 1)")
    known = known.filter(fold(F.col("k_id"), FOLDS) != HELD_OUT).groupBy("k_id").agg(F.min("label").alias("label"))
    rows = measured(docs, id_col, text_col, host, path)
    rows = stored(rows.join(known, F.col("doc_id") == F.col("k_id"), "left").drop("k_id"), "measures")
    model = fit(*_sample(rows, fit_rows))
    rows = stored(_with_own(rows, model), "evidence")
    evidence = F.coalesce(F.col("label").cast("double"), F.col("own"))
    paths = stored(rows.groupBy("host", "path").agg(F.sum(evidence).alias("good"), F.count(F.lit(1)).alias("n")), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "hosts")
    total = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    overall = (total.good + 1) / (total.n + 2) if total.n else 0.5
    mean = F.lit(overall)
    hosts = hosts.withColumn("strength", F.lit(strength(hosts, mean))).select(F.col("host").alias("h"), shrink(hosts, F.col("good"), F.col("n"), mean).alias("host_posterior"))
    nested = stored(paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h"), "paths-hosts")
    nested = nested.withColumn("strength", F.lit(strength(nested, F.col("host_posterior"))))
    sites = nested.select(F.col("host").alias("h"), F.col("path").alias("p"), "host_posterior", shrink(nested, F.col("good"), F.col("n"), F.col("host_posterior")).alias("path_posterior"))
    sites = stored(sites, "sites")
    out = rows.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    odds = F.ln(F.col("own") / (1 - F.col("own"))) + F.ln(F.col("path_posterior") / (1 - F.col("path_posterior"))) - float(np.log(overall / (1 - overall)))
    return out.select("doc_id", "host", "path", "own", "host_posterior", "path_posterior", (1 / (1 + F.exp(-odds))).alias("score"))


def _with_own(rows: DataFrame, model: Logistic) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column("x").to_pylist()).reshape(-1, len(MEASURES))
                own = pa.array(1 / (1 + np.exp(-model.logit(x))))
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "host", "path", "label")] + [own], names=["doc_id", "host", "path", "label", "own"])

    return rows.select("doc_id", "host", "path", "label", "x").mapInArrow(run, "doc_id long, host string, path string, label int, own double")


