import random
import re
from collections import Counter

import pytest

from tallygrid.llm import phrases as P


@pytest.fixture
def texts(spark):
    def make(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return frame.selectExpr("*", "'x' AS phrase", "1 AS n", "2 AS a", "3 AS size", "4 AS fp", "5 AS place", "6 AS score")

    return make


def plain(rows, longest, least):
    """Counts, scores and the phrases that stay, by dictionaries."""
    f, n, first = Counter(), Counter(), {}
    for i, text, lang in rows:
        lang, at = lang or "und", 0
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for size in range(1, longest + 1):
                for k in range(len(ws) - size + 1):
                    key = lang, tuple(ws[k : k + size])
                    f[key] += 1
                    first.setdefault(key, set()).add((i is None, i or 0, at + k))
            at += len(ws)
    f = {k: a for k, a in f.items() if a >= least}
    out = {}
    for (lang, ws), a in f.items():
        if len(ws) < 2:
            continue
        inside = any(
            other == lang and len(longer) > len(ws) and b >= a and any(longer[k : k + len(ws)] == ws for k in range(len(longer) - len(ws) + 1)) for (other, longer), b in f.items()
        )
        if not inside:
            score, k = min((1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws)))
            out[lang, " ".join(ws)] = (a, f[lang, ws[:k]], f[lang, ws[k:]], n[lang], score, first[lang, ws])
    return out


ROWS = [(1, None, "en"), (2, "", None), (None, "b c. b c", "en"), (3, "A b\tc  d, a B c d\x0be a b c d", None), (3, "A b c d", None), (4, "ä ß. Ä ß ä ß", "de")]


def some_rows(seed, vocabulary, n=60):
    rng = random.Random(seed)
    ends = [" "] * 9 + ["  ", "\t", ". ", ",", "\n", "\r\n", "! "]
    rows = [(rng.randrange(-20, 50), "".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(rng.randrange(80))), rng.choice(["en", "de", "und", None])) for _ in range(n)]
    return rows + ROWS + [(70, "long tail of words " * 3000, "en")]


@pytest.mark.parametrize("longest, least, vocabulary", [(5, 3, "a b c d e ab".split()), (3, 2, ["ä", "日本", "A", "b", "élan", "w" * 30]), (2, 10, "x y z".split()), (5, 4, "one two three".split())])
def test_same_as_dictionaries(texts, longest, least, vocabulary):
    rows = some_rows(longest, vocabulary)
    out = P.collocations(texts(rows).repartition(4), longest, least).collect()
    want = plain(rows, longest, least)
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in out} == {k: v[:5] for k, v in want.items()} and len(out) == len(want)
    for r in out:
        places = want[r.lang, r.phrase][5]
        assert (r.first_doc is None, r.first_doc or 0, r.first_word) in places and (r.first_doc is None, r.first_doc or 0) == min(p[:2] for p in places)


@pytest.mark.parametrize("bits", [0, 4, 9])
def test_colliding_fingerprints_are_told_apart_by_text(texts, bits):
    rows = some_rows(9, "a b c d e ab".split(), 30)
    want = plain(rows, 3, 3)
    out = P.collocations(texts(rows).repartition(3), 3, 3, bits).collect()
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in out} == {k: v[:5] for k, v in want.items()} and len(out) == len(want)
    assert all((r.first_doc is None, r.first_doc or 0, r.first_word) in want[r.lang, r.phrase][5] for r in out)


def test_first_rows_of_each_lang(texts):
    rows = some_rows(4, "a b c d e f".split())
    scored = P.collocations(texts(rows), 3, 2)
    out = P.first_of_each_lang(scored, 7).collect()
    for lang in {r.lang for r in out}:
        every = sorted(((-r.score, -r.a, r.phrase.encode()) for r in scored.collect() if r.lang == lang))[:7]
        assert [(-r.score, -r.a, r.phrase.encode()) for r in sorted(out, key=lambda r: r["rank"]) if r.lang == lang] == every
        assert [r["rank"] for r in sorted(out, key=lambda r: r["rank"]) if r.lang == lang] == list(range(1, len(every) + 1))


def test_nothing_frequent(texts):
    assert P.collocations(texts(ROWS), 5, 100).collect() == []
    assert P.collocations(texts([])).collect() == []
