"""The registered queries on the smallest tables: against their SQL, or against the plain rule of their contract."""

import hashlib
import os
import zlib

import public_tokenizers
import pytest
import tiktoken

from oracle import compare, connect
from tallygrid.llm.bpe import read_ranks
from tallygrid.llm.queries import ORACLES, QUERIES, op4_byte_packing, table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def rows(spark):
    return {r.doc_id: r for r in table(spark, SF_DIR, "documents").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []


def test_one_query_of_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_language(spark, rows):
    out = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, SF_DIR).collect()}
    assert out.keys() == rows.keys() and all(r.held_out == (fold(i, 3) == 1) for i, r in out.items())
    assert sum(out[i].lang_pred == rows[i].lang for i in rows) >= 0.97 * len(rows)


def test_byte_pairs(spark, rows):
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={}
    )
    out = QUERIES["op2_byte_bpe"](spark, SF_DIR).collect()
    assert len(out) == len(rows)
    for r in out:
        text = rows[r.doc_id].text or ""
        ids = encoding.encode_ordinary(text)
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()


def test_leaks_hold_their_items(spark, rows):
    items = {r.item_id: r.text for r in table(spark, SF_DIR, "benchmark").collect()}
    out = {(r.doc_id, r.item_id) for r in QUERIES["op3_template_decontamination"](spark, SF_DIR).collect()}
    whole = {(i, j) for i, r in rows.items() for j, t in items.items() if t in (r.text or "")}
    assert whole <= out


def test_packed_rows_hold_all_documents(spark, rows):
    out = QUERIES["op4_best_fit_packing"](spark, SF_DIR).collect()
    assert {i for r in out for i in r.doc_ids} == set(rows)
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={}
    )
    assert sum(r.n_tokens for r in out) == sum(len(encoding.encode_ordinary(r.text or "")) + 1 for r in rows.values())


def test_packed_bytes_hold_all_documents(spark, rows):
    out = op4_byte_packing(spark, SF_DIR).collect()
    assert {i for r in out for i in r.doc_ids} == set(rows)
    assert sum(r.n_tokens for r in out) == sum(len((r.text or "").encode()) + 1 for r in rows.values())


def test_secrets_are_the_assigned_values(spark):
    import re

    larger = "/root/testdata/sf0.01"  # the smallest tables hold no assigned value to learn from
    rows = {r.doc_id: r for r in table(spark, larger, "documents").collect()}
    out = QUERIES["op5_secret_forest"](spark, larger).collect()
    assigned = {(i, m) for i, r in rows.items() for m in re.findall(r'(?i)token = "([0-9a-f]{40})"', r.text or "")}
    assert assigned and assigned <= {(r.doc_id, r.candidate) for r in out if r.secret}
    assert not any(r.secret for r in out if r.candidate.isdigit())


def test_personal_data(spark, rows):
    from test_pii import plain

    out = {r.doc_id: r for r in QUERIES["op7_personal_data"](spark, SF_DIR).collect()}
    for i, r in rows.items():
        base = plain(r.text or "")
        assert out[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [out[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(x[0] == k for x in base) for k in ("email", "ip", "card", "phone")]


def test_scores(spark, rows):
    from test_lm import base

    out = QUERIES["op9_gru_scores"](spark, SF_DIR).collect()
    want = {w[0]: w for w in base([(i, r.text) for i, r in rows.items()], lambda i: fold(i, 10) != 0)}
    for r in out:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][1:4] and r.base_score == pytest.approx(want[r.doc_id][4])
        assert r.held_out == (fold(r.doc_id, 10) == 0) and r.score < 0


def test_pieces(spark, rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = QUERIES["op11_piece_bpe"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in out) == sorted(rows)
    for r in out:
        ids = library.encode(rows[r.doc_id].text or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
