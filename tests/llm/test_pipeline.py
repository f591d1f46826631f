import hashlib
import re

import corpus_pipeline
from pricewatch.llm import decontaminate, registry, simhash, toxicity
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_stages_against_brute_force(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    model = toxicity.fit(toxicity.labelled_sample(docs, labels))
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {i: r.text for i, r in rows.items() if model.score((r.text or "").encode()) < toxicity.ACCEPT}
    by_text = {}
    for i, t in kept.items():
        by_text[t.encode().lower()] = max(i, by_text.get(t.encode().lower(), i))
    kept = {i: kept[i] for i in by_text.values()}
    marks = {i: simhash.fingerprint(t.encode()) & (1 << 64) - 1 for i, t in kept.items()}
    group = {i: i for i in kept}
    changed = True
    while changed:
        changed = False
        for a in kept:
            for b in kept:
                if group[a] < group[b] and (marks[a] ^ marks[b]).bit_count() <= 3:
                    group[b], changed = group[a], True
    kept = {i: t for i, t in kept.items() if group[i] == i}
    automaton = decontaminate.SuffixAutomaton([(str(r.item_id), (r.text or "").encode()) for r in read(spark, "benchmark").collect()])
    final = {}
    for i, t in kept.items():
        words = decontaminate.words(t.encode())
        spans = automaton.scan(words)[0]
        hit = sum(b - a for a, b in spans)
        if not (hit and 20 * hit >= len(words)):
            places = [m.span() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", t.encode())]
            raw = t.encode()
            for a, b in reversed(spans):
                if b - a > 13:
                    raw = raw[: places[a][0]] + raw[places[b - 1][1] :]
            final[i] = raw.decode()
    stage, frames = docs, []
    for name, step in corpus_pipeline.STAGES:
        stage = corpus_pipeline.stored(step(spark, stage, SF), "test")
        frames.append((name, stage))
    assert [f.columns for _, f in frames[:-1]] == [docs.columns] * 4
    assert {r.doc_id: r.text for r in frames[3][1].collect()} == final
    tokens = {r.doc_id: r.n for r in stage.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    assert tokens == {i: len(t.encode().split()) + 1 for i, t in final.items()}


def test_every_operator_is_registered():
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in registry.QUERIES)] == []
    assert registry.QUERIES["pipeline"] is corpus_pipeline.run


def test_stages_take_empty_tables(spark):
    docs = read(spark, "documents").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
    assert docs.count() == 0


def test_contract_columns(spark):
    out = registry.QUERIES["op4_decontamination"](spark, SF).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(out) == read(spark, "documents").count()
    assert all((r.n_items == 0) == (r.items_sha256 == empty) == (r.n_hit == 0) for r in out)
