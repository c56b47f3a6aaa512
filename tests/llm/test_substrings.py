import random

import pytest

from tallygrid.llm.substrings import ladder, remove_repeats


def brute(rows, window):
    first = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for a in range(len(words) - window + 1):
            g = tuple(words[a : a + window])
            first[g] = min(first.get(g, 1 << 70), 1 << 69 if i is None else i)
    out = []
    for i, t in rows:
        words = (t or "").encode().split()
        gone = set()
        for a in range(len(words) - window + 1):
            if first[tuple(words[a : a + window])] < (1 << 69 if i is None else i):
                gone.update(range(a, a + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        out.append((-1 if i is None else i, len(words), len(gone), kept))
    return sorted(out)


def rows_of(frame):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in frame.collect())


@pytest.mark.parametrize("window, first", [(13, 7), (13, 4), (5, 5), (6, 2)])
def test_against_brute_force(docs, window, first):
    rng = random.Random(window * 10 + first)
    passages = [[f"p{rng.randrange(30)}" for _ in range(rng.randrange(3, 40))] for _ in range(12)]
    rows = []
    for i in rng.sample(range(1000), 120):
        words = []
        for _ in range(rng.randrange(0, 6)):
            words += rng.choice(passages) if rng.random() < 0.6 else [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(20))]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    assert rows_of(remove_repeats(docs(rows), window, first)) == brute(rows, window)


def test_nulls_repeated_rows_and_very_long_texts(docs):
    long = " ".join(f"x{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, long), (4, f"a {long} b"), (4, f"a {long} b"), (None, long), (6, "a " * 40), (7, "a " * 20), (8, "é" * 20), (9, "same short")]
    assert rows_of(remove_repeats(docs(rows))) == brute(rows, 13)
    assert remove_repeats(docs([])).collect() == []
    alone = [(1, "only one text " * 3)]
    assert rows_of(remove_repeats(docs(alone))) == brute(alone, 13)


def test_ladder_at_most_doubles():
    assert ladder(13, 7) == [7, 13] and ladder(13, 4) == [4, 7, 13] and ladder(5, 5) == [5] and ladder(50, 7) == [7, 13, 25, 50]
