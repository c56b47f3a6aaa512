import random

import pytest

from tallygrid.llm.components import components
from tallygrid.llm.neardup import near_duplicates


def shingles(text, k):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).encode().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(rows, k, percent=80):
    sets = {i: shingles(t, k) for i, t in rows}
    ids, root = sorted(sets), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            x = len(sets[a] & sets[b])
            if a < b and x and 100 * x >= percent * (len(sets[a]) + len(sets[b]) - x):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def corpus(n, seed, edits):
    """Groups of copies with edits, so that pairs lie on both sides of the threshold."""
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(500)}" for _ in range(rng.choice([1, 2, 5, 40, 80]))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(500)}"
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    return rows


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize("k, edits, star_rounds", [(2, 6, 4), (2, 10, 1), (5, 3, 2)])
def test_against_brute_force(docs, k, edits, star_rounds):
    rows = corpus(250, 7 * k + edits, edits)
    assert rows_of(near_duplicates(docs(rows), k=k, star_rounds=star_rounds)) == brute(rows, k)


def test_large_group_in_blocks(docs, monkeypatch):
    monkeypatch.setattr("tallygrid.llm.neardup.BLOCK_OUTLIERS", 7)
    monkeypatch.setattr("tallygrid.llm.neardup.BLOCK_MEMBERS", 11)
    rng, base = random.Random(5), [f"b{i}" for i in range(100)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(2, 9)):
            words[rng.randrange(100)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    assert rows_of(near_duplicates(docs(rows), k=2)) == brute(rows, 2)


def test_nulls_case_short_and_repeated_rows(docs):
    rows = [(1, None), (2, ""), (3, "  "), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\ntwo"), (8, "É"), (9, "é")]
    assert rows_of(near_duplicates(docs(rows), k=2)) == brute(rows, 2)
    repeated = near_duplicates(docs([(1, "a b c"), (1, "a b c"), (2, "A b c"), (None, "a b c")]), k=2).select("doc_id", "component_id", "kept").collect()
    assert sorted(map(str, repeated)) == sorted(
        ["Row(doc_id=1, component_id=1, kept=True)"] * 2 + ["Row(doc_id=2, component_id=1, kept=False)", "Row(doc_id=None, component_id=None, kept=True)"]
    )
    assert near_duplicates(docs([]), k=2).collect() == []


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(300, 300), (301, 302), (302, 301)]
    out = dict(components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert {out[i] for i in range(61)} == {0}
    assert {out[200 + i] for i in range(50)} == {100} and out[302] == 301 and 300 not in out
