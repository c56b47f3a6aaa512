import random

import numpy as np
import pytest

from tallygrid.llm.packing import EOS, PAD, best_fit_decreasing, byte_ids, pack, text_of, unpack


def plain(lengths, capacity):
    rooms = []
    for length in lengths:
        fits = [(r, k) for k, r in enumerate(rooms) if r >= length]
        if fits:
            rooms[min(fits)[1]] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


def test_best_fit_against_a_plain_search():
    rng = random.Random(1)
    for _ in range(400):
        capacity = rng.randrange(1, 50)
        lengths = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(60))), reverse=True)
        rows = best_fit_decreasing(lengths, capacity)
        rooms = [capacity] * (max(rows, default=-1) + 1)
        for length, row in zip(lengths, rows):
            rooms[row] -= length
        assert sorted(rooms) == plain(lengths, capacity)


@pytest.mark.parametrize("row_tokens, group_tokens", [(16, 500), (64, 1 << 20), (4096, 3000)])
def test_nothing_is_lost(docs, row_tokens, group_tokens):
    rng = random.Random(row_tokens)
    rows = [(i, rng.choice(["", "a", "é日😀", "word " * rng.randrange(100), "x" * 3000])) for i in range(150)]
    rows += [(900, None), (901, "same id"), (901, "other text"), (None, "no id")]
    packed = pack(docs(rows), row_tokens, group_tokens).cache()
    lengths = 0
    for r in packed.collect():
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == row_tokens and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert r.position_resets == r.cu_seqlens[:-1] and r.n_segments == len(r.doc_ids) == len(r.pieces)
        assert (ids[r.n_tokens :] == PAD).all() and (ids[: r.n_tokens] != PAD).all()
        assert all(a < b for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]))
        lengths += r.n_tokens
    assert lengths == sum(len((t or "").encode()) + 1 for _, t in rows)
    back = unpack(packed).select("doc_id", "text").collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((-1 if i is None else i or -1, t or "") for i, t in rows)


def test_ids_of_bytes_and_empty_tables(docs):
    assert byte_ids("é").tolist() == [0xC3 + 3, 0xA9 + 3, EOS] and text_of(byte_ids("é日")) == "é日"
    assert pack(docs([])).collect() == []


def test_registered_query_packs_the_ids_of_the_tokenizer(spark):
    import os

    import public_tokenizers

    from __spark_entry__ import queries
    from tallygrid.llm.packing import TokenIds
    from tallygrid.llm.queries import table

    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    encode = TokenIds(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    packed = queries()["op4_best_fit_packing"](spark, sf_dir).cache()
    for r in packed.collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == 8192 and (ids[r.n_tokens :] == encode.pad).all() and (ids[: r.n_tokens] <= encode.eos).all()
    assert sum(r.n_tokens for r in packed.collect()) == sum(len(encode(r.text or "")) for r in rows)
    back = unpack(packed, "<u4", encode.bytes_of).select("doc_id", "text").collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((r.doc_id, r.text or "") for r in rows)
