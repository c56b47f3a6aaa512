import random
import re

import pytest

from tallygrid.llm import exact
from tallygrid.llm.exact import drop_exact_copies, exact_duplicates
from tallygrid.session import materialize

BLANK = re.compile("[\x20\x09-\x0d]")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(BLANK.sub("", t or ""), []).append((-len(t or ""), i))
    out = []
    for i, t in rows:
        own = groups[BLANK.sub("", t or "")]
        out.append((i, min(own)[1], len(own), i == min(own)[1]))
    return sorted(out)


def got(frame):
    return sorted(tuple(r) for r in frame.select("doc_id", "keep_id", "group_size", "kept").collect())


def some(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice([None, "", " ", "a b", "ab", "a\tb ", " ab", "é x", "éx", "x" * 50, "long " * 4000])) for i in range(n)]


def test_against_brute_force(docs):
    rows = some(300, 1)
    assert got(exact_duplicates(docs(rows))) == brute(rows)


@pytest.mark.parametrize("table_bytes", [1, 500, 5000])
def test_small_tables_spill_level_by_level(docs, table_bytes):
    rows = some(120, 2) + [(1000 + i, f"text {i // 2}") for i in range(100)]
    assert got(exact_duplicates(docs(rows), table_bytes=table_bytes, fold_bytes=2000)) == brute(rows)


def test_levels_do_not_grow_with_the_rows(docs, monkeypatch):
    levels = []
    monkeypatch.setattr(exact, "materialize", lambda df, tag: levels.append(tag) or materialize(df, tag))
    for n in (200, 800, 3200):
        levels.clear()
        rows = [(i, f"{i % (n - 20):05d}" * 200) for i in range(n)]
        assert got(exact_duplicates(docs(rows), table_bytes=50_000, fold_bytes=20_000)) == brute(rows)
        assert len(levels) <= 2


@pytest.mark.parametrize("key_bytes", [0, 1])
def test_contents_are_compared_when_digests_clash(docs, key_bytes):
    rows = some(60, 3) + [(1000 + i, f"text {i // 2}") for i in range(20)]
    assert got(exact_duplicates(docs(rows), key_bytes=key_bytes, table_bytes=300)) == brute(rows)


def test_null_ids_repeated_rows_and_empty_tables(docs):
    assert exact_duplicates(docs([])).collect() == []
    rows = [(None, "a"), (3, "a"), (5, "b"), (5, "b"), (None, "c")]
    by_row = sorted(map(str, exact_duplicates(docs(rows)).select("doc_id", "keep_id", "group_size", "kept").collect()))
    assert by_row == sorted(
        [
            "Row(doc_id=None, keep_id=3, group_size=2, kept=False)",
            "Row(doc_id=3, keep_id=3, group_size=2, kept=True)",
            "Row(doc_id=5, keep_id=5, group_size=2, kept=True)",
            "Row(doc_id=5, keep_id=5, group_size=2, kept=True)",
            "Row(doc_id=None, keep_id=None, group_size=1, kept=True)",
        ]
    )


def test_drop_keeps_all_columns_and_one_row(docs):
    frame = docs([(None, "a"), (3, "a "), (5, "b"), (5, "b "), (7, None), (8, "")])
    out = drop_exact_copies(frame)
    assert out.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(3, "a "), (5, "b "), (7, None)]
