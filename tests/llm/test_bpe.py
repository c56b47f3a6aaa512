import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tallygrid.llm.bpe import Codec, Transducer, Utf8Stream, decode_documents, encode_documents, read_ranks

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


@pytest.mark.parametrize("max_states, max_pieces", [(100_000, 500_000), (50, 7)])
def test_same_ids_as_the_library(reference, max_states, max_pieces):
    codec = Codec(PATH, PATTERN, max_pieces)
    codec.transducer.max_states = max_states
    rng = random.Random(1)
    parts = ["a", "the", "ing", "é", "日本", "😀", "ك", "Z", "1", "23", "!", "=", "'s", "don't", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "\x1c", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        ids = codec.encode(text)
        assert ids == reference.encode_ordinary(text), repr(text)
        assert codec.decode_bytes(ids).decode() == text
    for text in ("", "a" * 3000, " " * 2000, "=-" * 1000, "é" * 700, "日" * 400):
        assert codec.encode(text) == reference.encode_ordinary(text)


def test_tiny_vocabulary_by_merging():
    ranks = {bytes([b]): b for b in range(256)}
    for k, token in enumerate([b"ab", b"bc", b"abc", b"ca", b"cab", b"aa", b"aaa", b"bca"]):
        ranks[token] = 256 + k
    machine, rng = Transducer(ranks), random.Random(2)
    for _ in range(3000):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 14)))
        plain = [ranks[t] for t in machine.rules.merge(piece)]
        assert machine.encode(piece) == ([ranks[piece]] if piece in ranks else plain), piece


def test_stream_decoding_of_any_bytes():
    rng = random.Random(3)
    some = [0x41, 0x80, 0xC3, 0xA9, 0xE6, 0x97, 0xA5, 0xF0, 0x9F, 0x98, 0xED, 0xFF, 0xE0, 0xF4]
    for _ in range(2000):
        raw, step = bytes(rng.choice(some) for _ in range(12)), rng.randrange(1, 6)
        stream = Utf8Stream()
        out = "".join(stream.feed(raw[i : i + step]) for i in range(0, 12, step)) + stream.end()
        assert out == raw.decode("utf8", "replace")


def test_round_trip_of_documents(docs, reference):
    rows = [(1, None), (2, ""), (3, "Héllo  wörld\n\n日本 😀 " * 50), (3, "again"), (None, "x"), (5, "word " * 50000)]
    encoded = encode_documents(docs(rows), PATH, PATTERN, with_ids=True)
    out = encoded.collect()
    assert len(out) == len(rows)
    by_sha = {r.decoded_sha256: r for r in out}
    for _, text in rows:
        row = by_sha[hashlib.sha256((text or "").encode()).hexdigest()]
        ids = reference.encode_ordinary(text or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (row.n_tokens, row.ids_sha256, bytes(row.ids)) == (len(ids), hashlib.sha256(raw).hexdigest(), raw)
    back = decode_documents(encoded, PATH, PATTERN, chunk_ids=3).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((i or 0, t or "") for i, t in rows)
    assert encode_documents(docs([]), PATH, PATTERN).collect() == []


def test_a_worker_keeps_one_model():
    from tallygrid.llm import text
    from tallygrid.llm.bpe import codec

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    own = codec(path, pattern, 100)
    assert codec(path, pattern, 100) is own
    list(text.slices(iter([]), keep=True))
    assert codec(path, pattern, 100) is own
    list(text.slices(iter([])))  # a task of an operator without a codec
    assert codec(path, pattern, 100) is not own


def test_many_texts_at_once_have_the_ids_of_the_library(reference, monkeypatch):
    import pyarrow as pa

    from tallygrid.llm import bpe

    monkeypatch.setattr(bpe, "BULK_WORDS", 50)
    codec, rng = Codec(PATH, PATTERN, 7), random.Random(4)
    parts = ["a", "the", "ing", "é", "ß", "日本", "😀", "ك", "Z", "1", "23", "!", "?", ",", "=", "'s", "don't", " ", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "\x1c", "\x00", "é", "ǅ", "ª", "Ⅷ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += [None, "", " ", "\n", "a\n", "\na", "a \nb", "a\n b", "a" * 3000, "word " * 500 + "end", "x" * 33 + ". " + "x" * 31 + "!", "é" * 40 + "\n" + "日" * 11]
    for some in (texts, [None], [""], []):
        found = codec.encode_all(pa.array(some, pa.string()))
        assert [list(memoryview(i).cast("I")) if i else [] for i in found] == [reference.encode_ordinary(t or "") for t in some]
    assert codec.encode_all(pa.array(texts, pa.string()).slice(700, 3)) == [codec.encode_bytes(t) for t in texts[700:703]]


def test_new_short_words_are_not_encoded_one_by_one(reference):
    import numpy as np
    import pyarrow as pa

    from tallygrid.llm.bpe import codec
    from tallygrid.llm.packing import TokenIds

    rng = random.Random(5)
    words = ["".join(rng.choice("aeiounrstlkéß") for _ in range(rng.randrange(4, 12))) + rng.choice(["", ",", "!!"]) for _ in range(3000)]
    texts, encode = [" ".join(words[k : k + 100]) for k in range(0, 3000, 100)], TokenIds(PATH, PATTERN)
    calls, machine = [], codec(PATH, PATTERN).transducer
    machine.encode, plain = lambda piece: calls.append(piece) or plain(piece), machine.encode
    try:
        found = encode.batch(pa.array(texts))
    finally:
        machine.encode = plain
    assert not calls
    for text, ids in zip(texts, found):
        assert ids.dtype == np.uint32 and ids.tolist() == [*reference.encode_ordinary(text), encode.eos]


def test_letters_of_arrow_are_letters_of_the_pattern():
    import pyarrow as pa
    import pyarrow.compute as pc
    import regex

    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    letters = pa.array(every, pa.large_string()).filter(pc.match_substring_regex(pa.array(every, pa.large_string()), "^\\pL$")).to_pylist()
    assert len(letters) > 130_000 and all(map(regex.compile(r"\p{L}").fullmatch, letters))


def test_a_vocabulary_whose_merges_miss_a_token(tmp_path):
    import base64

    import pyarrow as pa

    ranks = {bytes([b]): b for b in range(256)} | {b"abcd": 256, b"bc": 257}
    path = tmp_path / "odd.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for t, i in ranks.items()))
    codec = Codec(str(path), PATTERN)
    assert codec.encode_all(pa.array(["abcd", "x abcd", None])) == [codec.encode_bytes(t) for t in ("abcd", "x abcd", "")]
