import math
import random

import numpy as np
import pytest
from pricewatch.llm import hard_negatives as hn
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id string, limits string, slot int"


def brute(rows):
    """Anchors are ids divisible by 50; everything from the rule."""
    fit = {}
    for i, v, c, *_ in rows:
        if None in (i, v, c) or any(x is None or not math.isfinite(x) for x in v):
            continue
        key = (c, [math.floor(256 * float(np.float32(x))) for x in v])
        fit[i] = min(fit.get(i, key), key)
    out = []
    for a, (label, v) in fit.items():
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, c) for i, (c, w) in fit.items() if i != a)
        positives = [(-s, i) for s, i, c in scored if c == label][:5]
        for p, pid in positives:
            inside = [(-s, i) for s, i, c in scored if c != label and 50 * p <= -100 * s <= 95 * p][:3]
            out += [(a, pid, r, i, p, s) for r, (s, i) in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hn.mine(df.repartition(3), F.col("vec_id") % 50 == 0).collect())


def vectors(rng, n, dim=6, labels=4):
    centre = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    out = []
    for i in range(n):
        c = rng.randrange(labels)
        out.append((i, [x * 0.5 + rng.gauss(0.3, 0.5) for x in centre[c]], c))
    return out


@pytest.mark.parametrize("rows_each, anchors_each", [(64, 4), (8192, 1024)])
def test_equals_all_pairs(spark, monkeypatch, rows_each, anchors_each):
    monkeypatch.setattr(hn, "ROWS", rows_each)
    monkeypatch.setattr(hn, "ANCHORS", anchors_each)
    rng = random.Random(2)
    rows = vectors(rng, 700)
    rows += [(1000 + i, rows[50][1], i % 2) for i in range(150)]  # a very common vector: ties
    rows += [(2000, None, 1), (2050, [1.0, float("nan")], 1), (2100, [1.0, None], 1), (2150, [1.0] * 6, None), (2200, [], 0), (2250, [0.5, 2.0], 1), (None, [1.0], 1)]
    rows += [(2300, [0.0] * 6, 2), (2301, [0.0] * 6, 2), (2302, [0.0] * 6, 3)]
    assert mined(spark, rows) == brute(rows)


def test_repeated_rows_are_one(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.7, 0.0], 2), (2, [0.7, 0.0], 2), (2, [0.9, 0.0], 3)]
    assert mined(spark, rows) == brute(rows) == [(0, 1, 1, 2, 65536, 45824)]


def test_large_components_are_exact(spark):
    rows = [(0, [3e6, -2e6], 1), (1, [2.5e6, 1e6], 1), (2, [1.25e6, 1e5], 2), (3, [1.3e6, 2e5], 2)]
    assert mined(spark, rows) == brute(rows) != []


def test_slots_merge_downwards():
    slots = {0: [(90, 1), (88, 2), (87, 3)], 1: [(70, 4)], 2: [(50, 5), (50, 6)]}
    got = hn.merge_windows([(100, 11), (80, 12), (60, 13)], slots)
    assert got == [(11, 1, 1, 100, 90), (11, 2, 2, 100, 88), (11, 3, 3, 100, 87), (12, 1, 4, 80, 70), (12, 2, 5, 80, 50), (12, 3, 6, 80, 50), (13, 1, 5, 60, 50), (13, 2, 6, 60, 50)]


def test_scores_beyond_64_bits_saturate():
    big = np.array([[1 << 40, 1 << 40]])
    assert hn.scores(big, big).tolist() == [[(1 << 63) - 1]]
    assert hn.scores(big, -big).tolist() == [[-(1 << 63) + 1]]


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
