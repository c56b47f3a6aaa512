import random

from pyspark.sql import functions as F

from tallygrid.llm.secrets import candidates, dictionary, features, label_by_name, scan

RNG = random.Random(3)


def key(n=40, chars="0123456789abcdef"):
    return "".join(RNG.choice(chars) for _ in range(n - 2)) + "a1"


def corpus():
    rows = [(i, f"the value of the thing is token = \"{key()}\" and more words follow here") for i in range(60)]
    rows += [(100 + i, f"the order number {RNG.randrange(10**15, 10**16)} was sent to the yard today") for i in range(60)]
    rows += [(200, f"see also \"{key()}\" here"), (201, f"path /usr/share/reports2024archive/x and 1234567890123456"), (202, None), (203, ""), (None, f"secret: {key(32)}")]
    return rows


def test_forest_keeps_keys_and_drops_numbers(docs):
    out = scan(docs(corpus())).collect()
    by_doc = {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert all(by_doc[i][0].secret for i in range(60)) and not any(by_doc[100 + i][0].secret for i in range(60))
    assert by_doc[200][0].secret and by_doc[None][0].secret and 202 not in by_doc and 203 not in by_doc
    assert not [r for r in by_doc[201] if r.candidate == "1234567890123456"][0].secret


def test_candidates_against_plain_search(docs):
    import re

    rows = corpus() + [(300, f"two {key(20)},{key(20)} in one\nword {key(15)} {'b' * 30}"), (301, " lead " + key(16))]
    want = set()
    for i, text in rows:
        for w, word in enumerate(re.split("[\x20\x09-\x0d]+", text or "")):
            for n, m in enumerate(re.finditer("[A-Za-z0-9+/_=-]{16,}", word)):
                if re.search("[0-9]", m[0]):
                    want.add((i, w, n, m[0]))
    got = {(r.doc_id, r.word_no, r.run_no, r.candidate) for r in candidates(docs(rows)).collect()}
    assert got == want


def test_labelled_findings_teach_the_forest(docs):
    frame = docs(corpus())
    found = features(candidates(frame), dictionary(frame))
    # Reviewers say the opposite: the forest follows them.
    labels = found.withColumn("label", F.col("digits_only")).select("doc_id", "row", "word_no", "run_no", "label")
    out = scan(frame, labelled=labels).filter("doc_id between 0 and 159").collect()
    assert all(r.secret == (r.doc_id >= 100) for r in out)


def test_features_repeated_rows_and_empty_tables(docs):
    frame = docs([(1, "word reports2024archive99 word"), (1, "word reports2024archive99 word"), (2, "reports reports archive")])
    rows = features(candidates(frame), dictionary(frame)).collect()
    assert [round(r.coverage, 4) for r in rows] == [round(14 / 20, 4)] * 2  # reports and archive, of 20 characters
    assert scan(docs([])).collect() == []
    only = scan(docs([(1, "x 1234567890123456 y")])).collect()
    assert [(r.secret, r.probability) for r in only] == [(True, None)]


def test_assigned_values_of_any_length_are_candidates(docs):
    rows = [(1, "password: hunter2"), (2, "the db_password = 'swordfish' here"), (3, 'pwd="two words!" end'), (4, "x?token=abc&key=de"), (5, "token ='q-1' and secret :=zz"), (6, "no name: hunter2")]
    got = sorted((r.doc_id, r.word_no, r.candidate) for r in candidates(docs(rows)).collect())
    assert got == [(1, 1, "hunter2"), (2, 3, "swordfish"), (3, 0, "two words!"), (4, 0, "abc"), (4, 0, "de"), (5, 1, "q-1"), (5, 4, "zz")]


def test_quoted_values_of_any_length(docs):
    value = " ".join(f"word{i}" for i in range(40))
    rows = [(1, f'the password = "{value}" ends'), (2, f"secret='{value}' ends \"x\""), (3, 'token="don\'t tell them 1" y'), (4, 'pwd = "open and 7 never closed'), (5, "key: `a` and `b c`")]
    got = sorted((r.doc_id, r.candidate) for r in candidates(docs(rows)).filter("named").collect())
    assert got == [(1, value), (2, value), (3, "don't tell them 1"), (4, "open"), (5, "a")]


def test_a_bare_key_is_no_negative_and_a_quote_no_proof(docs):
    rows = corpus() + [(300 + i, f"we found {key()} in the yard") for i in range(60)] + [(400 + i, f'the order "{RNG.randrange(10**15, 10**16)}" was sent') for i in range(60)]
    frame = docs(rows)
    labels = {r.doc_id: r.label for r in label_by_name(features(candidates(frame), dictionary(frame))).collect()}
    assert all(labels[300 + i] is None and labels[400 + i] == 0.0 for i in range(60))
    out = {r.doc_id: r.secret for r in scan(frame).collect()}
    assert all(out[300 + i] for i in range(60)) and not any(out[400 + i] for i in range(60))
