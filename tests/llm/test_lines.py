import random

from pricewatch.llm import lines


def brute(rows, min_words=lines.MIN_WORDS):
    seen, first, out = {}, {}, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        here = set()
        for digest, k, a, b, n in lines.units((text or "").encode(), min_words):
            owner = first.setdefault(digest, i)
            if digest in here or owner != i:
                out.append((i, k, a, b, n, owner))
            here.add(digest)
            seen.setdefault(digest, set()).add(i)
    return sorted(out, key=str)


def passage(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


def test_units_cover_whole_lines_and_keep_offsets():
    text = "One two  three four\tfive SIX\nshort line\n\nÉa é two three four five six.\n"
    got = [(a, b, n, text[a:b]) for _, _, a, b, n in lines.units(text.encode(), 1)]
    assert " ".join(x[3] for x in got).split() == text.split()
    assert sum(x[2] for x in got) == len(text.split())
    same = [d for d, *_ in lines.units(b"A  b\tC d e f", 1)]
    assert same == [d for d, *_ in lines.units(b"a b c D e F", 1)]


def test_long_passages_meet_inside_other_lines():
    rng = random.Random(6)
    caught = 0
    for _ in range(200):
        shared = passage(rng, 51)
        one = {d for d, *_ in lines.units(f"{passage(rng, 30)} {shared} {passage(rng, 9)}".encode())}
        two = {d for d, *_ in lines.units(f"{passage(rng, 3)} {shared} {passage(rng, 40)}".encode())}
        caught += bool(one & two)
    assert caught >= 196
    clean = [{d for d, *_ in lines.units(passage(rng, 300).encode())} for _ in range(100)]
    assert len(set().union(*clean)) == sum(map(len, clean))


def test_repeats_against_brute_force(docs):
    rng = random.Random(9)
    pool = [passage(rng, rng.randint(3, 40)) for _ in range(12)]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 5)) + [passage(rng, 12)])) for i in range(60)]
    rows += [(100, None), (101, ""), (None, pool[0] + "\n" + pool[1]), (102, "w " * 60_000), (103, "\n" * 1000)]
    got = lines.repeats(docs(*rows)).collect()
    assert sorted(((r.doc_id, r.unit, r.start, r.stop, r.n_words, r.keep_doc_id) for r in got), key=str) == brute(rows)


def test_repeated_lines_go_whole(docs):
    rng = random.Random(12)
    pool = [passage(rng, n) for n in [*range(1, 31)] * 6]
    rows = [(i, "\n".join(line.upper() if rng.random() < 0.2 else line for line in rng.sample(pool, 20))) for i in range(40)]
    # Brute force: of equal whole lines the earliest stays, the others go with all their words.
    seen, want = set(), {}
    for i, text in rows:
        want[i] = []
        for line in text.split("\n"):
            want[i].append("" if line.lower() in seen else line)
            seen.add(line.lower())
    got = {r.doc_id: [" ".join(x.split()) for x in r.text.split("\n")] for r in lines.remove(docs(*rows)).collect()}
    assert got == want


def test_short_ends_stay_with_a_line_that_stands_once():
    rng = random.Random(13)
    for _ in range(200):
        line, other = passage(rng, 40), passage(rng, 40)
        ends = {d for d, *_, n in lines.units(line.encode()) if n < lines.MIN_WORDS}
        assert not ends & {d for d, *_ in lines.units(f"{line} {other}\n{other} {line}".encode())}


def test_removal(docs):
    a, b = "this line is in several documents", "and this one stands here only once"
    rows = [(1, f"{a}\n{b}"), (2, f"é {b} x\n{a.upper()}\nend"), (3, None), (4, f"{a}\n{a}"), (4, f"{a}\n{a}"), (None, a)]
    table = docs(*rows)
    out = lines.remove(table)
    assert out.columns == [*table.columns, "removed"]
    got = sorted(((r.doc_id, r.text, [(s.start, s.stop) for s in r.removed]) for r in out.collect()), key=str)
    assert got == sorted([(1, f"{a}\n{b}", []), (2, f"é {b} x\n\nend", [(39, 72)]), (3, None, []), (4, "\n", [(0, 33), (34, 67)]), (4, "\n", [(0, 33), (34, 67)]), (None, "", [(0, 33)])], key=str)


def test_empty(docs):
    assert lines.repeats(docs()).count() == 0 and lines.remove(docs()).count() == 0
