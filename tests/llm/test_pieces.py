import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tallygrid.llm.pieces import Encoder, decode_pieces, encode_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the", "ing", "é", "日本", "😀", "ك", "Z", "1", "23", "!", "=", "'s", "don't", " ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", " ", "\x00", "▁", "<s>", "<0x41>", "</s>", ".", ",", "e.", "𓀀", "�"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts_of(rng, n):
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(25))) for _ in range(n)]


@pytest.mark.parametrize("max_segments", [250_000, 7])
def test_same_ids_and_texts_as_the_library(library, max_segments):
    own = Encoder(PATH, max_segments)
    long = ["", " ", "\n", " \n ", "a" * 3000, " " * 2000, "=-" * 1000, "é" * 700, "日" * 400, "ab " * 5000, "▁" * 50, "x\n" * 300]
    for text in long + texts_of(random.Random(1), 4000):
        ids = own.encode(text)
        want = library.encode(text)
        assert ids == b",".join(b"%d" % i for i in want), repr(text)
        assert own.vocabulary.decode(ids.split(b",") if ids else []) == library.decode(want), repr(text)
    own.check()
    assert own.unchecked == []


def test_segments_together_as_one_by_one():
    """Pairs of equal score, and segments of different lengths in one round."""
    own, rng = Encoder(PATH).vocabulary, random.Random(5)
    segments = ["".join(rng.choice("▁▁aeinotr.é日") for _ in range(rng.randrange(1, 33))) for _ in range(4000)]
    assert own.merged_together(segments) == [own.ids(s) for s in segments]
    assert own.ids_of(["", "𓀀x", "a" * 99, *segments[:9]]) == [own.ids(s) for s in ["", "𓀀x", "a" * 99, *segments[:9]]]


def test_whole_texts_through_one_agenda(library):
    """A vocabulary whose pieces join across blanks is not cut into words."""
    own = Encoder(PATH)
    own.by_words = False
    for text in texts_of(random.Random(2), 500):
        assert own.encode(text) == b",".join(b"%d" % i for i in library.encode(text)), repr(text)


def test_decoding_of_any_ids(library):
    own, rng = Encoder(PATH).vocabulary, random.Random(3)
    some = [0, 1, 2, *range(3, 259), *[1, 2, 259, 264, 28705, 1318, 13] * 20]
    for _ in range(3000):
        ids = [rng.choice(some) for _ in range(rng.randrange(9))]
        assert own.decode([b"%d" % i for i in ids]) == library.decode(ids), ids


def test_a_wrong_piece_is_found(library):
    own = Encoder(PATH)
    own.vocabulary.digits[own.vocabulary.symbols.index("▁the")] = b"7"
    own.encode("the")
    with pytest.raises(ValueError, match="of the library"):
        own.check()


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto.FromString(open(PATH, "rb").read())
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    path = tmp_path / "other.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="no merge-type"):
        Encoder(str(path))


def test_documents(docs, library):
    rows = [(1, None), (2, ""), (3, "Héllo  wörld\n\n日本 😀 " * 50), (3, "again"), (None, "x"), (5, "word " * 50000)]
    encoded = encode_pieces(docs(rows), PATH, with_ids=True)
    out = encoded.collect()
    assert sorted((r.doc_id or 0, r.ids) for r in out) == sorted((i or 0, library.encode(t or "")) for i, t in rows)
    for r in out:
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(r.ids).encode()).hexdigest()
    back = decode_pieces(encoded, PATH).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((i or 0, t or "") for i, t in rows)
    assert encode_pieces(docs([]), PATH).collect() == []
