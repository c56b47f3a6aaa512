import hashlib
import random

import public_tokenizers
import tiktoken

import corpus_pipeline as P
from tallygrid.llm.bpe import read_ranks

LANGS = {"aa": ["banana", "kaka", "lala", "mamama", "papa"], "bb": ["drim", "strinx", "pfilk", "krunx", "schtop"]}


def prose(lang, n, rng):
    return " ".join(rng.choice(LANGS[lang]) + rng.choice(["", "x", "y", "zu", "qe"]) + str(rng.randrange(40)) for _ in range(n))


def corpus():
    """Rows by what has to become of them."""
    rng = random.Random(1)
    stays = {i: (prose(lang, rng.randrange(30, 80), rng), lang) for i, lang in enumerate(["aa", "bb"] * 15)}
    items = [prose("aa", 30, rng) for _ in range(3)]
    goes = {
        100: (None, "aa"), 101: ("12 34 $$", None), 102: ("", "bb"),
        103: (stays[3][0].replace(" ", "\n"), "bb"),
        104: (" ".join(stays[4][0].split()[:-1]), "aa"),
        105: (f"{prose('aa', 30, rng)} {items[1]} {prose('aa', 10, rng)}", "aa"),
    }
    stays[200] = (prose("aa", 5, rng), None)
    return stays, goes, items


def test_stages_against_what_was_planted(spark, tmp_path):
    stays, goes, items = corpus()
    rows = [(i, t, lang, "src", len(t or "")) for i, (t, lang) in (stays | goes).items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    alive = set(stays) | set(goes)
    for (name, stage), gone in zip(P.STAGES[:-1], [{100, 101, 102}, {103}, {104}, {105}]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        kept = {r.doc_id for r in out.collect()}
        assert alive - kept == gone, name
        alive, docs = kept, docs.join(out.select("doc_id"), "doc_id").select(*docs.columns)

    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    result = {r.doc_id: r for r in P.run(spark, str(tmp_path)).collect()}
    assert set(result) == set(stays)
    for i, (text, _) in stays.items():
        ids = encoding.encode_ordinary(text)
        assert bytes(result[i].ids) == b"".join(x.to_bytes(4, "little") for x in ids)
        assert result[i].n_tokens == len(ids) and result[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_other_columns_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = "doc_id long, text string, lang string, source string, n_chars long"
    strange = plain + ", _pred string, _score double, id string, keep string, _keep string, _sha string, _place int, n int, rep long"
    for schema, rows in ((plain, []), (strange, [(1, "kaka lala papa", "aa", None, None, "x", 1.0, "x", "x", "x", "x", 1, 1, 1)] * 2)):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), schema)
        assert docs.count() == len(rows[:1])
        assert P.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows[:1])
