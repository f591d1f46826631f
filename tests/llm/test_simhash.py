import random

import numpy as np
import xxhash
from pricewatch.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 40_000):
        text = " ".join(rng.choices(["Aa", "bé", "c,", "dd"], k=n))
        assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == brute_fingerprint(text)


def roots(values):
    up = {v: v for v in values}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= 3:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {v: root(v) for v in values}


def cluster(rng, n):
    out = set()
    for _ in range(6):
        center = rng.getrandbits(64)
        for _ in range(n // 6):
            v = center
            for b in rng.sample(range(64), rng.randint(0, 5)):
                v ^= 1 << b
            out.add(v)
        v = center
        for b in rng.sample(range(16), 3):  # three bits of one block
            v ^= 1 << b
        out.add(v)
    return sorted(out)


def test_links_give_the_components_of_all_pairs(spark):
    rng = random.Random(4)
    values = cluster(rng, 240)
    signed = [simhash._signed(v) for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r.node: r.root for r in simhash.components(simhash.links(frame, len(signed))).collect()}
    groups, found = {}, {}
    for v, r in roots(values).items():
        groups.setdefault(r, set()).add(simhash._signed(v))
    for v in signed:
        found.setdefault(got.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))
    assert all(r == min(members) for r, members in found.items())


def test_every_distance_meets():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a = int(rng.integers(0, 1 << 63))
        bits = rng.choice(64, int(rng.integers(1, 4)), replace=False)
        if rng.random() < 0.3:
            bits = rng.choice(16, 3, replace=False) + 16 * int(rng.integers(0, 4))
        b = a
        for x in bits.tolist():
            b ^= 1 << int(x)
        rows = [((v & keep) ^ flip, (block << 6 | k) << 16 | v >> 16 * block & 0xFFFF) for v in (a, b) for block, keep, flip, k in simhash._masks()]
        key = np.array([simhash._signed(x) for x, _ in rows], dtype=np.int64)
        edges = simhash.variant_edges(key, np.array([t for _, t in rows], dtype=np.int64))
        assert (min(a, b), max(a, b)) in {tuple(map(int, e)) for e in edges}


def test_documents(docs):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text), (9, text + " more"), (2, text.upper()), (7, None), (8, ""), (11, "other words"), (None, text), (11, "other words"), (3, "z " * 60_000)]
    got = {}
    for r in simhash.decide(docs(*rows)).collect():
        got.setdefault(r.component_id, []).append(r.doc_id)
    assert {k: sorted(v, key=str) for k, v in got.items()} == {2: [2, 5, 9, None], 7: [7, 8], 11: [11, 11], 3: [3]}
    table = docs(*rows)
    kept = simhash.deduplicate(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 7, 11]


def test_empty(docs):
    assert simhash.decide(docs()).count() == 0 and simhash.deduplicate(docs()).count() == 0
