import random
import re

import pytest
from pricewatch.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normal(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=13):
    words, hit, ids = normal(text), set(), set()
    for item_id, item in items:
        own = normal(item)
        n = min(window, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1 if own else 0):
            if tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                ids.add(item_id)
    return len(words), len(hit), ids


def test_automaton_against_windows():
    rng = random.Random(2)
    for _ in range(200):
        letters = "abcd"[: rng.randint(1, 4)]
        items = [(str(i), " ".join(rng.choices(letters, k=rng.randint(0, 9)))) for i in range(6)]
        text = " ".join(rng.choices(letters + "x", k=40))
        automaton = d.SuffixAutomaton([(i, t.encode()) for i, t in items], 4)
        spans, ids = automaton.scan(d.words(text.encode()))
        assert (sum(b - a for a, b in spans), ids) == brute(text, items, 4)[1:]


@pytest.fixture
def items(spark):
    rows = [(1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen."), (2, "short ITEM"), (3, None), (4, ""), (2, "short item"), (5, "...")]
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, found string")


TEXT = "zero one TWO three four five six seven eight nine ten eleven twelve thirteen fourteen end"


@pytest.mark.parametrize("block_words", [1, 5, 200_000])
def test_documents(docs, items, block_words):
    rows = [(1, TEXT), (2, None), (3, ""), (4, "Short-item é"), (5, "word " * 50_000 + "short item"), (5, TEXT), (None, TEXT)]
    table = docs(*rows)
    out = d.annotate(table, items, into="got", block_words=block_words)
    assert out.columns == [*table.columns, "got"]
    known = [(str(r.item_id), r.text) for r in items.collect()]
    want = sorted((i if i is not None else -1, *brute(t, known)) for i, t in rows)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.got.n_words, sum(s.end - s.start for s in r.got.spans), set(r.got.item_ids)) for r in out.collect())
    assert got == want


def test_contaminated_rows_go_and_long_spans_are_cut(docs, items):
    rows = [(1, TEXT), (2, "word " * 400 + TEXT), (3, "clean text"), (4, None)]
    kept = {r.doc_id: r.text for r in d.drop_contaminated(docs(*rows), items).collect()}
    assert kept == dict(rows[1:])
    cut = {r.doc_id: r.text for r in d.remove_spans(docs(*rows), items).collect()}
    assert cut == {2: "word " * 400 + "zero  end", 3: "clean text", 4: None}


def test_empty(docs, items):
    assert d.drop_contaminated(docs(), items).count() == 0
    assert d.drop_contaminated(docs((1, "a")), items.limit(0)).count() == 1
