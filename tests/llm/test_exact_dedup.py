import hashlib
import random

from pricewatch.llm import exact_dedup
from pricewatch.llm.exact_dedup import CuckooIndex


def key(n):
    return hashlib.sha256(str(n).encode()).digest()


def test_index_inserts_deletes_and_resizes():
    index, live, rng = CuckooIndex(buckets=2), {}, random.Random(3)
    for step in range(6000):
        n = rng.randrange(1500)
        if rng.random() < 0.4:
            assert index.delete(key(n)) == (n in live)
            live.pop(n, None)
        elif index.get(key(n)) is None:
            assert n not in live
            index.insert(key(n), [step])
            live[n] = [step]
    assert index.resizes > 3
    assert all(index.get(key(n)) == live.get(n) for n in range(1500))
    assert dict(index.items()) == {key(n): v for n, v in live.items()}


def test_false_positive_is_verified():
    index = CuckooIndex()
    a = key(1)
    index.insert(a, [1])
    twin = a[:10] + bytes(22)  # same places and mark, other digest
    assert index.might_have(twin) and index.get(twin) is None and not index.delete(twin)


def test_decisions(docs):
    rows = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (5, "É"), (6, "é"), (None, "a b"), (7, "x" * 300_000), (2, "A B")]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.decide(docs(*rows)).collect()}
    assert got == {
        (1, 2, 4, False), (2, 2, 4, True), (None, 2, 4, False), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True), (6, 6, 1, True), (7, 7, 1, True)
    }


def test_deduplicate_keeps_columns_and_one_of_repeated_rows(docs):
    table = docs((1, "a"), (2, "A"), (2, "a"), (2, "a"), (None, "n"), (None, "N"), (3, "b"))
    out = exact_dedup.deduplicate(table)
    assert out.columns == table.columns
    assert sorted((r.doc_id or -1, r.text.lower()) for r in out.collect()) == [(-1, "n"), (2, "a"), (3, "b")]


def test_empty(docs):
    assert exact_dedup.decide(docs()).count() == 0 and exact_dedup.deduplicate(docs()).count() == 0


def test_live_index_over_batches(docs):
    rows = exact_dedup.digests(docs((1, "a"), (2, "b"), (3, "b")))
    index = exact_dedup.update_index(rows)
    gone = exact_dedup.digests(docs((0, "A"))).select("digest")
    index = exact_dedup.update_index(exact_dedup.digests(docs((9, "b"), (8, "c"))), index, gone)
    assert sorted((r.keep_id, r.group_size) for r in index.collect()) == [(8, 1), (9, 3)]
