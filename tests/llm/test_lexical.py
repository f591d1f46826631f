import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pricewatch.llm import lexical


def plain_terms(text):
    out, word = [], ""
    for c in text or "":
        if c.isascii() and not c.isalnum():
            out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return [w for w in [*out, word] if w]


def brute(docs, items, k):
    """Every item against every document, straight from the rule."""
    found = [(i, plain_terms(t)) for i, t in docs]
    found = [(i, w) for i, w in found if w]
    n_docs, n_terms = len(found), sum(len(w) for _, w in found)
    df = Counter(t for _, w in found for t in set(w))
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(plain_terms(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, w in found:
            tf, m = Counter(w), 50 + (50 * len(w) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in terms if tf[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def texts(rng, n, words=60):
    vocabulary = [f"w{i}" for i in range(words)] + ["Ähre", "naïve", "x2"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 30))) for _ in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block, group", [(4, 16), (32, 2048)])
def test_equals_every_item_against_every_document(spark, docs, monkeypatch, block, group):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "GROUP", group)
    rng = random.Random(5)
    found = list(enumerate(texts(rng, 300)))
    found += [(i, "w1 w2 w3") for i in range(400, 460)]  # a group of copies: ties
    found += [(900, None), (901, ""), (902, "--- !!"), (None, "w1 w2 w3"), (903, "W1,W2;w3 " * 5000), (5, "w7 w7"), (5, "w7 w7")]
    items = [(i, t) for i, t in enumerate(texts(rng, 20))] + [(50, None), (51, "zzz unseen"), (52, "W1 w1, w2"), (None, "w3 ähre Ähre"), (7, "w9")]
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = lexical.rank(docs(*found).repartition(3), asked, k=10)
    assert rows(got) == sorted(brute(found, items, 10), key=repr)


def test_items_in_blocks(spark, docs, monkeypatch):
    rng = random.Random(6)
    found, items = list(enumerate(texts(rng, 100))), list(enumerate(texts(rng, 30)))
    monkeypatch.setattr(lexical, "TERMS", 40)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert rows(lexical.rank(docs(*found), asked, k=5)) == sorted(brute(found, items, 5), key=repr)


def test_skipped_blocks_hold_nothing_better():
    """Blocks are skipped, and the best stay those of a full scan."""
    rng = np.random.default_rng(3)
    n, size = 600, 40
    topic = rng.integers(0, 8, n)
    present = rng.random((n, size)) < 0.1
    for t in range(8):
        present[topic == t, t * 5 : t * 5 + 5] = True
    impact = np.where(present, rng.integers(1, 50, (n, size)) + 500 * (np.arange(size)[None, :] // 5 == topic[:, None]), 0)
    doc, term = np.nonzero(impact)
    index = lexical.Index(doc, term, impact[doc, term], n, size)
    queries = lexical.Queries([[0, 1, 2], [6, 8, 30], [39]], np.ones(size, dtype=np.int64))
    held = lexical.Best(3, 5)
    read, skipped = lexical.search(index, np.arange(n), queries, held)
    assert skipped > read / 4
    for q, terms in enumerate(queries.items):
        total = impact[:, terms].sum(axis=1)
        best = sorted(range(n), key=lambda i: (-total[i], i))[:5]
        assert held.doc[q].tolist() == best and held.score[q].tolist() == total[best].tolist()
    for t, coords, _ in queries.terms:
        posting, found, start, summary = index.blocks(t, coords)
        assert sorted(posting.tolist()) == np.flatnonzero(impact[:, t]).tolist()
        for a, b, most in zip(start, [*start[1:], len(posting)], summary, strict=True):
            assert (found[a:b].max(axis=0) == most).all()


def test_empty(spark, docs):
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert lexical.rank(docs(), items).count() == 0
    assert lexical.rank(docs((1, "w1")), items.limit(0)).count() == 0
