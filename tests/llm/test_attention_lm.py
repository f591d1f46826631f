import math
import random
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pricewatch.llm import attention_lm as lm


def one_by_one(p, ids):
    """Attention and null share of each id, id by id, from the rule."""
    wq, wk, bias, null = lm._unpack(p)
    padded = [lm.PAD, lm.PAD, *ids]
    context = [np.concatenate([lm.CODES[padded[i + 1]], lm.CODES[padded[i]]]) for i in range(len(ids))]
    out = []
    for i in range(len(ids)):
        begin = max(0, (i // lm.BLOCK - 1) * lm.BLOCK)
        w = [math.exp(min(40.0, (context[i] @ wq) @ (context[j] @ wk) + bias[i - j])) for j in range(begin, i)]
        total = sum(w) + math.exp(null)
        out.append((sum(x for x, j in zip(w, range(begin, i)) if ids[j] == ids[i]) / total, math.exp(null) / total))
    return np.array(out)


def parameters(seed):
    return lm.first_parameters() + np.random.default_rng(seed).normal(0, 0.1, len(lm.first_parameters()))


def test_batched_attention_equals_id_by_id():
    rng = np.random.default_rng(3)
    p = parameters(1)
    p[-1] = 3.0
    streams = [rng.integers(0, 6, n).astype(np.int16) for n in (1, 15, 16, 17, 50, 129)]
    ids, places = lm.lay_out(streams)
    hit, null = lm.attend(p, ids, chunk=3)
    got = np.stack([hit, null], 1)[places - lm.BLOCK]
    want = np.concatenate([one_by_one(p, s.tolist()) for s in streams])
    np.testing.assert_allclose(got, want, rtol=2e-4, atol=1e-6)


def test_predictions_sum_to_one():
    rng = np.random.default_rng(0)
    table = lm.shares(rng.integers(0, 3, (lm.IDS, lm.IDS)).astype(float))
    np.testing.assert_allclose(table.sum(axis=1), 1, rtol=1e-4)
    p, begin = parameters(2), rng.integers(0, 9, 20)
    total = 0.0
    for last in range(9):
        hit, _ = lm.attend(p, lm.lay_out([np.append(begin, last).astype(np.int16)])[0])
        total += hit[20]
    _, null = lm.attend(p, lm.lay_out([np.append(begin, 0).astype(np.int16)])[0])
    assert abs(total + null[20] - 1) < 1e-4


def test_gradient():
    rng = np.random.default_rng(4)
    p = parameters(5)
    p[-1] = 2.0
    ids, places = lm.lay_out([rng.integers(0, 5, 40).astype(np.int16), rng.integers(0, 5, 7).astype(np.int16)])
    inside = np.ones(len(ids))
    inside[places] = rng.uniform(0.1, 0.9, len(places))
    g, loss, n = lm.gradient(p, ids, inside)
    assert n == 47
    for i in (0, 5, 300, 512 + 1, 512 + 9, len(p) - 1):
        step = np.zeros_like(p)
        step[i] = 1e-3
        slope = (lm.gradient(p + step, ids, inside)[1] - lm.gradient(p - step, ids, inside)[1]) / 2e-3
        assert abs(slope - g[i]) < 1e-2 * max(1, abs(slope))


def test_subwords_spell_the_words():
    subwords = lm.Subwords(lm.vocabulary_path())
    for word in (b"the", "überströmung".encode(), b"\xff\xfe", b"a" * 1000):
        ids = np.frombuffer(subwords.of(word), dtype=np.int16)
        assert (ids[:-1] < lm.PIECES).all() and lm.PIECES <= ids[-1] < 2 * lm.PIECES
        assert b"".join(subwords.bpe.decode_single_token_bytes(int(i) % lm.PIECES) for i in ids) == word


def make(rng, n):
    syllables = ["ka", "lo", "mi", "tu", "re", "san"]
    common = ["the", "of", "and"]
    return " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


def test_scores(docs):
    rng = random.Random(7)
    rows = [(i, make(rng, rng.randint(1, 120))) for i in range(400)]
    for i in range(400, 430):
        rows.append((i, (make(rng, 30) + " ") * 4))  # held-out repeats inside a text
    rows += [(500, None), (501, ""), (502, "THE the"), (502, "THE the"), (None, "the"), (503, "the " * 30_000)]
    out = lm.score(docs(*rows)).collect()
    counts, n_docs = Counter(), 0
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            counts.update((t or "").lower().split())
            n_docs += 1
    total, distinct = sum(counts.values()) + n_docs, len(counts) + 1
    floor = math.log10(total + 0.1 * (distinct + 1))
    want = []
    for i, t in rows:
        found = (t or "").lower().split()
        base = sum(math.log10(counts[w] + 0.1) for w in found) + math.log10(n_docs + 0.1) - (len(found) + 1) * floor
        want.append((-1 if i is None else i, i is None or zlib.crc32(str(i).encode()) % 10 == 0, len(found) + 1, sum(w in counts for w in found) + 1, total, round(base, 4)))
    got = [(-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out]
    assert sorted(got) == sorted(want)
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in out)


def test_scores_do_not_depend_on_the_length_of_the_list(docs, monkeypatch):
    rng = random.Random(8)
    rows = [(i, make(rng, rng.randint(1, 120)) + " " + rng.choice(["zug", "baum", "apfel"]) * 3) for i in range(200)]
    want = {r.doc_id: r for r in lm.score(docs(*rows)).collect()}
    monkeypatch.setattr(lm, "KNOWN_WORDS", 20)
    for r in lm.score(docs(*rows)).collect():
        assert (r.n_tokens, r.n_known, round(r.base_score, 6)) == (want[r.doc_id].n_tokens, want[r.doc_id].n_known, round(want[r.doc_id].base_score, 6))
        assert abs(r.score - want[r.doc_id].score) < 0.002 * abs(want[r.doc_id].score)


def test_training_sees_every_word(monkeypatch):
    rng = random.Random(9)
    texts = [make(rng, n).encode() for n in (0, 1, 64, 65, 5000, 200, 1300)]
    seen, streams = [], lm.Listed.streams
    monkeypatch.setattr(lm.Listed, "streams", lambda self, part: seen.extend(part) or streams(self, part))
    known = [lm.END_WORD], np.full((1, lm.KINDS), 7.0)
    value = ("every-word", lm.vocabulary_path(), known, np.full(lm.KINDS, 9.0), 2, np.full((lm.IDS, lm.IDS), 1 / lm.IDS), lm.first_parameters(), 0.3)
    n = len(texts)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts, pa.binary()), pa.array([[b"the"]] * n, pa.list_(pa.binary())), pa.array([[2] * lm.KINDS] * n, pa.list_(pa.int64()))],
        names=["text", "others", "other_counts"],
    )
    out = list(lm._train(SimpleNamespace(value=value))(iter([batch])))
    assert [w for run in seen for w in run] == [w for t in texts for w in t.split()]
    assert [len(run) for run in seen[:5]] == [0, 1, 64, 64, 1] and max(map(len, seen)) == 64
    values = out[0].column("v").to_numpy()
    assert values[len(lm.first_parameters())] == -(-len(seen) // 64) and (values[-len(lm.WEIGHTS) :] > 0).all()


def test_empty(docs):
    assert lm.score(docs()).count() == 0


def test_split_equals_python():
    rng = random.Random(11)
    texts = [b"", b" ", b"\x1f a\x85b", b"One\x0btwo\x0c \tTHREE\r\n", "Ünï ÄB c".encode(), bytes(range(256)), b"\xff\xfe \xc3"]
    texts += [bytes(rng.choices(b"aB \t\n\x1c\xa0", k=rng.randint(0, 30))) for _ in range(200)]
    found, sizes = lm.split(pa.array([b"cut off", *texts], pa.binary()).slice(1))
    want = [t.lower().split() for t in texts]
    assert found.to_pylist() == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want]


def test_pieces_hold_all_rows_within_bounds(monkeypatch):
    monkeypatch.setattr(lm, "BYTES_AT_ONCE", 10)
    monkeypatch.setattr(lm, "TEXTS_AT_ONCE", 3)
    texts = [b"", b"a" * 50, b"b" * 6, b"c" * 4, b"d", *[b""] * 7, b"e" * 10, b"f" * 11]
    pieces = [p.column("text").to_pylist() for p in lm.pieces_of([pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])])]
    assert [t for p in pieces for t in p] == texts
    assert all(len(p) == 1 or len(p) <= 3 and sum(map(len, p)) <= 10 for p in pieces) and len(pieces) == 7


def test_streams_spell_word_by_word():
    rng = random.Random(12)
    texts = [make(rng, n).encode() for n in (0, 3, 70, 1, 200)] + [b"zug " * 5, b""]
    for known in ([], [b"the", b"ka"], [lm.END_WORD, b"the", b"of", b"lomi"]):
        listed = lm.Listed(lm.vocabulary_path(), known)
        for most in (None, 64):
            runs = list(listed.runs(pa.array(texts, pa.binary()), most))
            want = [w for r in runs for w in (*r, lm.END_WORD)]
            places, found, ids, begins, sizes = listed.streams(runs)
            assert places.tolist() == [known.index(w) if w in known else len(known) for w in want]
            assert found == {i: w for i, w in enumerate(want) if w not in known}
            spelt = [np.frombuffer(listed.subwords.of(w), dtype=np.int16).tolist() for w in want]
            assert [x.tolist() for x in np.split(ids, begins[1:])] == spelt
            assert sizes.tolist() == [sum(len(listed.subwords.of(w)) // 2 for w in (*r, lm.END_WORD)) for r in runs]


def test_a_step_does_not_copy_the_list():
    listed = lm.Listed(lm.vocabulary_path(), [lm.END_WORD, *(b"w%d" % i for i in range(100_000))])
    runs = list(listed.runs(pa.array([b"w7 w99999 zug"] * 64, pa.binary()), 64))
    listed.streams(runs)
    tracemalloc.start()
    listed.streams(runs)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 200_000


def test_only_earlier_keys_of_the_text_are_found():
    ids, _ = lm.lay_out([np.array([5, 6, 5, 5], dtype=np.int16), np.array([7] * 20, dtype=np.int16)])
    found = lm._equal(lm._pairs(ids), ids[lm.BLOCK :].reshape(-1, lm.BLOCK))
    assert len(found) == 3 + 20 * 19 // 2


def test_words_are_counted_by_kind_across_flushes(docs, monkeypatch):
    rng = random.Random(13)
    texts = [make(rng, rng.randint(0, 80)).encode() for _ in range(150)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[at : at + 20], pa.binary())], names=["text"]) for at in range(0, 150, 20)]
    x = np.array([lm.profile(t) for t in texts])
    mean, vectors = x.mean(axis=0), np.linalg.svd(x - x.mean(axis=0))[2][: lm.COMPONENTS].T
    want = Counter()
    for t in texts:
        want.update((w, lm.kind(t, mean, vectors)) for w in (*t.split(), lm.END_WORD))
    monkeypatch.setattr(lm, "CACHE_WORDS", 40)
    got = Counter()
    frame = SimpleNamespace(mapInArrow=lambda run, _: rows.extend(run(iter(batches))) or frame, groupBy=lambda _: frame, agg=lambda *_: None)
    rows: list[pa.RecordBatch] = []
    docs()  # a session for the columns
    lm.word_counts(frame, mean, vectors)
    for r in (r for b in rows for r in b.to_pylist()):
        got[r["word"], r["kind"]] += r["n"]
    assert got == want


def test_steps_do_not_depend_on_the_bytes_held_at_once(monkeypatch):
    rng = random.Random(14)
    texts = [make(rng, rng.randint(0, 300)).encode() for _ in range(60)]
    value = ("bytes", lm.vocabulary_path(), ([lm.END_WORD, b"the"], np.full((2, lm.KINDS), 7.0)), np.full(lm.KINDS, 99.0), 2, np.full((lm.IDS, lm.IDS), 1 / lm.IDS), lm.first_parameters(), 0.3)
    none = [pa.array([None] * 60, pa.list_(pa.binary())), pa.array([None] * 60, pa.list_(pa.int64()))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), *none], names=["text", "others", "other_counts"])
    want = next(lm._train(SimpleNamespace(value=value))(iter([batch]))).column("v")
    monkeypatch.setattr(lm, "BYTES_AT_ONCE", 900)
    assert next(lm._train(SimpleNamespace(value=value))(iter([batch]))).column("v").equals(want)
