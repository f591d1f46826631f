import random

import numpy as np
from pricewatch.llm import quality
from pyspark.sql import functions as F


def good(rng):
    return " ".join("".join(rng.choices("aeioukltrs", k=rng.randint(2, 9))) for _ in range(rng.randint(20, 200))) + "."


def bad(rng):
    return rng.choice([lambda: good(rng).upper().replace(" ", "!! "), lambda: "buy now " * rng.randint(20, 90), lambda: good(rng).replace(" ", "### ")])()


def tables(spark, n=600):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        host = rng.choice(["good.site"] * 6 + ["bad.site"] * 2 + [f"tiny{i}"])
        q = int(rng.random() < {"good.site": 0.95, "bad.site": 0.1}.get(host, 0.7))
        rows.append((i, good(rng) if q else bad(rng), host, rng.choice(["a", "b"]), "x"))
        labels.append((i, q))
    rows += [(None, "null id text here", None, None, "x"), (9000, None, "bad.site", None, "x"), (9001, "", "good.site", "a", "x"), (9001, "", "good.site", "a", "x"), (9002, "w " * 100_000, "good.site", "zz", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, lang string, score string")
    return docs, spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, quality int")


def test_scores(spark):
    docs, labels = tables(spark)
    out = quality.score(docs, labels, F.col("host"), F.col("lang")).collect()
    assert len(out) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    held = [(truth[r.doc_id], r.score >= quality.KEEP) for r in out if r.doc_id in truth and hash_fold(r.doc_id) == quality.HELD_OUT]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    hosts = {r.host: r.host_posterior for r in out}
    assert hosts["good.site"] > 0.85 > hosts["bad.site"] + 0.5
    tiny = [v for k, v in hosts.items() if k and k.startswith("tiny")]
    assert max(tiny) - min(tiny) < hosts["good.site"] - hosts["bad.site"]
    assert all(0 < r.score < 1 for r in out)


def hash_fold(i):
    import zlib

    return zlib.crc32(str(i).encode()) % quality.FOLDS


def test_flat_without_labels_and_empty(spark):
    docs, labels = tables(spark, 5)
    out = quality.score(docs, labels.limit(0), F.col("host"), F.col("lang")).collect()
    assert {round(r.own, 6) for r in out} == {0.5}
    assert quality.score(docs.limit(0), labels, F.col("host"), F.col("lang")).count() == 0


def test_shrinkage_strength(spark):
    rng = np.random.default_rng(1)
    rates = rng.beta(20, 10, 300)
    sites = spark.createDataFrame([(float(rng.binomial(200, p)), 200) for p in rates], "good double, n long")
    assert 20 < quality.strength(sites, F.lit(2 / 3)) < 45
