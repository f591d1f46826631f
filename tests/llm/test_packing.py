import random
from collections import Counter

from pricewatch.llm import packing
from pricewatch.llm.packing import attention_cost


def one_by_one(lengths, capacities, largest):
    """Best-fit decreasing piece by piece, with the same rule for opening and the same shrinking."""
    supply = lambda room: sum(n for n in lengths if n <= room)
    bins = []  # [size, contents, time of the last change]: of bins with equal room, the one left alone longest is filled
    for time, n in enumerate(sorted(lengths, reverse=True)):
        fits = [b for b in bins if b[0] - sum(b[1]) >= n]
        if fits:
            chosen = min(fits, key=lambda b: (b[0] - sum(b[1]), b[2]))
        else:
            bins.append(chosen := [packing.opening_size(n, capacities, largest, attention_cost, supply), [], 0])
        chosen[1].append(n)
        chosen[2] = time
    return [(next(c for c in capacities if c >= sum(x)), x) for _, x, _ in bins]


def bins_of(lengths, plan):
    starts = {}
    for number, n in enumerate(sorted(lengths, reverse=True)):
        k = max(i for i, f in enumerate(plan.first) if f <= number)
        b = plan.bin[k] + (number - plan.first[k]) // plan.each[k]
        at = plan.used[k] + (number - plan.first[k]) % plan.each[k] * plan.length[k]
        assert plan.length[k] == n
        starts.setdefault(b, []).append((at, n))
    out = []
    for b, content in sorted(starts.items()):
        content.sort()
        assert [a for a, _ in content] == [sum(n for _, n in content[:i]) for i in range(len(content))]
        size = plan.bin_size[max(i for i, f in enumerate(plan.bin_first) if f <= b)]
        out.append((size, [n for _, n in content]))
    return out


def test_plan_equals_piece_by_piece():
    rng = random.Random(5)
    for case in range(60):
        capacities = ((8, 16, 32), (10,), (5, 7, 40))[case % 3]
        lengths = [rng.randint(1, capacities[-1]) for _ in range(rng.randint(0, 60))]
        if case % 4 == 0:
            lengths += [3] * 40
        for rule in (c for c in capacities if c >= max(lengths, default=0)):
            made = packing._fill(dict(Counter(lengths)), capacities, rule, attention_cost)
            want = one_by_one(lengths, capacities, rule)
            assert sorted((s, sorted(x)) for s, x in bins_of(lengths, made)) == sorted((s, sorted(x)) for s, x in want)
            assert made.cost == sum(attention_cost(s) for s, _ in want)


def test_best_rule_is_taken():
    histogram = dict(Counter([100] * 7 + [900, 500]))
    best = packing.plan(histogram)
    assert best.cost == min(packing._fill(histogram, packing.CAPACITIES, c, attention_cost).cost for c in (1024, 2048, 4096))


def test_documents(docs):
    rows = [(1, "a b c"), (2, None), (3, ""), (None, "x y"), (4, "w " * 10_000), (4, "w " * 10_000), (5, " \t a\x0bb  c ")]
    out = packing.pack(docs(*rows), capacities=(4, 8, 16)).collect()
    want = Counter()
    for i, t in rows:
        want[i] += len((t or "").split()) + 1
    got = Counter()
    for r in out:
        got[r.doc_id] += r.n_tokens
    assert got == want
    places = {}
    for r in out:
        assert r.bin_offset + r.n_tokens <= r.bin_size
        places.setdefault(r.bin_id, []).append((r.bin_offset, r.n_tokens))
    for content in places.values():
        content.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(content, content[1:]))
    long = sorted((r.piece, r.start, r.n_tokens) for r in out if r.doc_id == 4)
    assert long[0][1:] == (0, 16) and long[-1][1:] == (10_000 // 16 * 16, 10_001 % 16)


def test_empty(docs):
    assert packing.pack(docs()).count() == 0
