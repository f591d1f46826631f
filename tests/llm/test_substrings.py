import hashlib
import random

import numpy as np
import pytest
from pricewatch.llm import substrings as sub


def brute(rows, length):
    """Every string of ``length`` bytes of every text, counted."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = {}
    for _, x in texts:
        for k in range(len(x) - length + 1):
            count[x[k : k + length]] = count.get(x[k : k + length], 0) + 1
    out = []
    for i, x in texts:
        gone = np.zeros(len(x), dtype=bool)
        for k in range(len(x) - length + 1):
            if count[x[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        kept = np.frombuffer(x, dtype=np.uint8)[~gone].tobytes()
        out.append((-1 if i is None else i, len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    out = []
    for r in df.collect():
        removed = sum(s.length for s in r.spans)
        out.append((-1 if r.doc_id is None else r.doc_id, r.n_bytes, removed, len(r.spans), bytes(r.kept_digest).hex()))
        if r.kept is not None:
            assert hashlib.sha256(r.kept).digest() == r.kept_digest and len(r.kept) == r.n_bytes - removed
    return sorted(out)


def prose(rng, n):
    return " ".join("".join(rng.choices("aeiouklmnrst", k=rng.randint(1, 8))) for _ in range(n))


def corpus(rng):
    passage, other = prose(rng, 120), prose(rng, 80)
    rows = [(i, prose(rng, rng.randint(0, 200))) for i in range(30)]
    rows += [(100 + i, prose(rng, 30) + passage + prose(rng, 20)) for i in range(12)]
    base = prose(rng, 300).split()
    for i in range(25):  # near copies: some words replaced
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = prose(rng, 1)
        rows.append((200 + i, " ".join(copy)))
    rows += [(300, other), (301, other), (301, other), (302, other[:-1])]
    rows += [(400, "ab" * 700), (401, "b" * 450), (402, "a" * 399), (403, "abc" * 20 + passage[:420] * 2)]
    rows += [(500, None), (501, ""), (None, passage), (502, "é" * 300 + other[:100]), (503, "é" * 210)]
    return rows


@pytest.mark.parametrize("hot", [50_000, 3])
def test_equals_all_substrings(docs, monkeypatch, hot):
    monkeypatch.setattr(sub, "HOT", hot)
    rows = corpus(random.Random(1))
    assert found(sub.deduplicate(docs(*rows))) == brute(rows, sub.LENGTH)


def test_small_parts_and_runs(docs, monkeypatch):
    """Texts read in parts, many runs a task, many partitions of the merge."""
    monkeypatch.setattr(sub, "PART", 500)
    monkeypatch.setattr(sub, "HELD", 20_000)
    monkeypatch.setattr(sub, "MERGE", 20)
    rows = corpus(random.Random(2))
    assert found(sub.deduplicate(docs(*rows).repartition(4))) == brute(rows, sub.LENGTH)


def test_anchors_are_chosen_by_the_window_alone():
    rng = random.Random(3)
    for text in (prose(rng, 400).encode(), b"ab" * 900, bytes(rng.choices(range(2), k=2000))):
        chosen = {}
        for start, n, anchor, gram in sub.anchors(text):
            for s, k, a, g in zip(start.tolist(), n.tolist(), anchor.tolist(), gram.tolist(), strict=True):
                for w in range(s, s + k):
                    assert 0 <= a - w <= sub.LENGTH - sub.GRAM
                    chosen[w] = (a - w, g)
        assert sorted(chosen) == list(range(len(text) - sub.LENGTH + 1))
        for w in range(0, len(text) - sub.LENGTH + 1, 37):
            (start, n, anchor, gram) = next(sub.anchors(text[w : w + sub.LENGTH]))
            assert (int(anchor[0]), int(gram[0])) == chosen[w]


def test_front_coding_round_trip():
    rng = random.Random(4)
    strings = sorted(bytes(rng.choices(b"ab", k=rng.randint(0, 20))) for _ in range(300))
    out, shared = sub.front_decode(*sub.front_code(strings))
    assert out == strings
    assert shared[1:] == [sub.common(a, b) for a, b in zip(strings, strings[1:])]


def test_loser_tree_merges_without_comparing_known_prefixes():
    rng = random.Random(5)
    runs = [sorted(b"prefix" * 30 + bytes(rng.choices(b"abc", k=rng.randint(0, 12))) for _ in range(rng.randint(0, 60))) for _ in range(7)]
    tree = sub.LoserTree([sub.front_decode(*sub.front_code(r)) for r in runs])
    got = [(runs[r][k], n) for r, k, n in tree]
    want = sorted(x for r in runs for x in r)
    assert [x for x, _ in got] == want
    assert [n for _, n in got][1:] == [sub.common(a, b) for a, b in zip(want, want[1:])]
    # Comparing whole strings would look at the 180 common bytes again and again.
    assert tree.compared < 40 * len(want)


def test_repeated_windows_against_all_pairs():
    rng = random.Random(6)
    for _ in range(40):
        centre = prose(rng, 60).encode()[:200]
        units = []
        for _ in range(rng.randint(2, 9)):
            left, right = rng.choice([b"x", b"yx", b"zzx"]) * 70, rng.choice([b"k", b"kl", b"klm"]) * 70
            units.append((centre + right[: rng.randint(0, 200)], left[-rng.randint(0, 200) :][::-1]))
        units.sort()
        shared = [0] + [sub.common(a[0], b[0]) for a, b in zip(units, units[1:])]
        got = set()
        for j, a, b in sub.repeated_windows(shared, [u[1] for u in units]):
            got |= {(j, o) for o in range(a, b + 1)}
        want = set()
        for j, (ra, la) in enumerate(units):
            for i, (rb, lb) in enumerate(units):
                if i != j:
                    want |= {(j, o) for o in range(sub.LENGTH - sub.common(ra, rb), sub.common(la, lb) + 1)}
        assert got == want


def test_spans_and_removal():
    assert sub.remove(b"0123456789", [{"offset": 2, "length": 3}, {"offset": 9, "length": 1}]) == b"015678"


def test_empty(docs):
    assert sub.deduplicate(docs()).count() == 0
