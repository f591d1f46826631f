import random

import pytest
from pricewatch.llm import toxicity

RNG = random.Random(8)
SYLLABLES = ["ka", "lo", "mi", "tu", "re", "san", "der", "vo", "pli", "gon"]
WORDS = ["".join(RNG.choices(SYLLABLES, k=RNG.randint(1, 3))) for _ in range(400)]
BAD = ["zxqworst", "blurgh", "kzkzk", "xyzzyx", "grmpf"]


def text(rng, toxic):
    words = rng.choices(WORDS, k=rng.randint(5, 200))
    for _ in range(rng.randint(1, 4) * toxic):
        words.insert(rng.randrange(len(words)), rng.choice(BAD))
    return " ".join(words)


def rows(seed, n):
    rng = random.Random(seed)
    return [(text(rng, k), k) for k in (int(rng.random() < 0.2) for _ in range(n))]


def test_held_out_accuracy():
    model = toxicity.fit([(t.encode(), k) for t, k in rows(1, 900)])
    test = rows(2, 400)
    right = sum((model.score(t.encode()) >= toxicity.ACCEPT) == bool(k) for t, k in test)
    assert right >= 0.97 * len(test)
    false = [t for t, k in test if not k and model.score(t.encode()) >= toxicity.ACCEPT]
    assert len(false) <= 2


def test_no_toxic_labels():
    assert toxicity.fit([]).score(b"x") == 0.0 and toxicity.fit([(b"a", 0)]).score(b"") == 0.0


@pytest.fixture(scope="module")
def trained(spark):
    made = rows(3, 900)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(made)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k) for i, (_, k) in enumerate(made)] + [(None, 1), (5, None), (10**6, 1)], "doc_id long, toxic int")
    return docs, labels, toxicity.fit(toxicity.labelled_sample(docs, labels))


def test_documents(docs, trained):
    table = docs((1, None), (2, ""), (3, "blurgh"), (3, "blurgh"), (None, "kzkzk! BLURGH zxqworst"), (4, "ka lo " * 100_000), (5, " ".join(WORDS[:80]) + " xyzzyx grmpf " + " ".join(WORDS[80:160])))
    out = toxicity.score(table, trained[2], into="got")
    assert out.columns == [*table.columns, "got"]
    got = [(r.doc_id, r.got >= toxicity.ACCEPT, 0 <= r.got <= 1) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, False, True), (2, False, True), (3, True, True), (3, True, True), (None, True, True), (4, False, True), (5, True, True)], key=str)


def test_filter_keeps_clean_rows(docs, trained):
    table = docs((1, None), (2, "blurgh kzkzk"), (3, "ka lo mi"), (3, "ka lo mi"))
    source, labels, _ = trained
    both = table.unionByName(source, allowMissingColumns=True)
    kept = toxicity.drop_toxic(both, labels)
    assert kept.columns == both.columns
    assert sorted(r.doc_id for r in kept.filter("source = 's'").collect()) == [1, 3, 3]


def test_empty(docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.drop_toxic(docs(), none).count() == 0
    assert toxicity.drop_toxic(docs((1, "a")), none).count() == 1
