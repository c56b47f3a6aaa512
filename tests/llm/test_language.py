import random

import numpy as np
import pyarrow as pa
import pytest

from tallygrid.llm.language import Model, fit, letter_words, lowered, predict, spans, viterbi

WORDS = {"aa": ["banana", "kaka", "lala"], "bb": ["drim", "strinx", "pfilk"], "ru": ["привет", "мир", "дом"]}


def text(lang, n, rng):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(text(lang, 40, rng), lang) for lang in WORDS for _ in range(20)] + [(None, "aa"), ("xx", None)]
    return fit(spark.createDataFrame(rows, "text string, lang string"))


def test_whole_texts(docs, model):
    rng = random.Random(2)
    rows = [(i, text(lang, rng.choice([1, 5, 300]), rng).upper()) for i, lang in enumerate(list(WORDS) * 10)]
    out = {r.doc_id: r for r in predict(docs(rows), model).collect()}
    assert all(out[i].lang_pred == lang for i, lang in enumerate(list(WORDS) * 10))
    assert all(0 <= r.score <= 1 for r in out.values())


def test_no_letters_unknown_scripts_and_empty_tables(docs, model, spark):
    rows = [(1, None), (2, ""), (3, "12 $ — 5"), (4, "שלום"), (None, "kaka lala"), (6, "kaka " * 30000)]
    out = {r.doc_id: (r.lang_pred, r.score) for r in predict(docs(rows), model).collect()}
    assert out[1] == out[2] == out[3] == ("und", 0.0)
    assert out[4][0] in WORDS and out[4][1] == 0.0
    assert out[None] == ("aa", 1.0) and out[6] == ("aa", 1.0)
    assert predict(docs([]), model).collect() == []
    empty = fit(spark.createDataFrame([], "text string, lang string"))
    assert [r.lang_pred for r in predict(docs([(1, "abc")]), empty).collect()] == ["und"]


def test_spans_of_mixed_text(docs, model):
    rng = random.Random(3)
    first, second, third = text("aa", 12, rng), text("ru", 12, rng), text("bb", 12, rng)
    whole = f"{first} {second} {third}"
    got = [(r.start, r.end, r.lang) for r in spans(docs([(1, whole), (2, None)]), model).orderBy("start").collect()]
    a, b = len(first) + 1, len(first) + 1 + len(second) + 1
    assert got == [(0, len(first), "aa"), (a, a + len(second), "ru"), (b, len(whole), "bb")]


def test_script_narrows_the_languages(model):
    assert model.langs == ["aa", "bb", "ru"]
    assert model.candidates[1].tolist() == [True, True, False] and model.candidates[3].tolist() == [False, False, True]


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(4)
    many = np.array([1, 5, 3, 5])
    firsts = np.concatenate([[0], np.cumsum(many)[:-1]])
    scores = rng.normal(0, 3, (many.sum(), 3)).astype(np.float32)
    labels = viterbi(scores, firsts, many, 2.0)

    def value(path, part):
        return sum(part[t, x] for t, x in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

    for a, n in zip(firsts, many):
        part = scores[a : a + n]
        paths = np.stack(np.meshgrid(*[range(3)] * n), -1).reshape(-1, n)
        best = max(value(p, part) for p in paths.tolist())
        assert value(labels[a : a + n].tolist(), part) == pytest.approx(best, abs=1e-4)


def test_lower_case_keeps_lengths():
    sample = "ÀÉÞß ÑÖ× ΑΩΠΡΣ АЯРП ABZ"
    low = lowered(np.frombuffer(sample.encode(), np.uint8)).tobytes().decode()
    assert low == "àéþß ñö× αωπρσ аярп abz"
    starts, ends, rows, script, _ = letter_words(np.frombuffer(low.encode(), np.uint8), np.array([0, len(low.encode())]))
    assert [low.encode()[a:b].decode() for a, b in zip(starts, ends)] == ["àéþß", "ñö", "αωπρσ", "аярп", "abz"]
    assert Model([]).langs == []
    assert pa.array(script).to_pylist() == [1, 1, 2, 3, 1]
