"""The registered queries of the numbered operators, with their SQL where SQL can express them."""

from __future__ import annotations

import os
import shutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallygrid.session import shared_dir

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its function name."""

    def register(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship_code(spark: SparkSession) -> None:
    """Give the package to the workers of a local session that was started somewhere else without PYTHONPATH.

    On a cluster the package is installed or passed with --py-files.
    """
    known = [os.path.realpath(p or ".") for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), "."]]
    work = shared_dir(spark).removeprefix("file:")
    if ROOT in known or not spark.sparkContext.master.startswith("local[") or not work.startswith("/"):
        return
    archive = os.path.join("/" + work.lstrip("/"), f"code-{spark.sparkContext.applicationId}.zip")
    if not os.path.exists(archive):
        os.makedirs(os.path.dirname(archive), exist_ok=True)
        shutil.make_archive(archive.removesuffix(".zip"), "zip", ROOT, "tallygrid")
        spark.sparkContext.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    sql="""
    WITH n AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
    k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
    """
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallygrid.llm.exact import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


@query(
    sql="""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 2 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) WHEN len(ws) = 1 THEN ws ELSE [] END) AS g FROM w),
    z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM common JOIN z p ON p.doc_id = a JOIN z q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id, doc_id AS r FROM w UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r)
    SELECT w.doc_id, coalesce(max(z.n), 0)::BIGINT AS n_shingles, min(r) AS component_id, w.doc_id = min(r) AS kept
    FROM w LEFT JOIN z USING (doc_id) JOIN reach USING (doc_id) GROUP BY w.doc_id
    """
)
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallygrid.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), k=2)


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tallygrid.llm.language import fit, held_out, predict

    docs = table(spark, sf_dir, "documents")
    test = held_out(F.col("doc_id"), 3, 1)
    model = fit(docs.filter(~test))
    return predict(docs, model).select("doc_id", test.alias("held_out"), "lang_pred", "score")


@query()
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tallygrid.llm.bpe import encode_documents

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, max_pieces=300_000)


@query()
def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallygrid.llm.decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    sql="""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    win AS (SELECT doc_id, i, list_aggregate(ws[i : i + 12], 'string_agg', ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
    origin AS (SELECT g, min(doc_id) AS low FROM win GROUP BY g),
    hit AS (SELECT win.doc_id, i FROM win JOIN origin USING (g) WHERE low < win.doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM hit),
    words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS t FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
    SELECT w.doc_id, len(ws)::BIGINT AS n_words, len(ws)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
    """
)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallygrid.llm.substrings import kept_digests, remove_repeats

    return kept_digests(remove_repeats(table(spark, sf_dir, "documents")))


@query()
def op9_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tallygrid.llm.language import held_out
    from tallygrid.llm.lm import score_documents

    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, ~held_out(F.col("doc_id"), 10, 0))
    return scored.select("doc_id", held_out(F.col("doc_id"), 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallygrid.llm.pii import find_personal_data, span_digests

    return span_digests(find_personal_data(table(spark, sf_dir, "documents")))


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of op2_byte_bpe, packed."""
    import public_tokenizers

    from tallygrid.llm.packing import TokenIds, pack

    encode = TokenIds(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return pack(table(spark, sf_dir, "documents"), encode=encode, pad=encode.pad)


def op4_byte_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The UTF-8 bytes packed instead, a smaller job; registered beside the others in __spark_entry__."""
    from tallygrid.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


@query()
def op5_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallygrid.llm.secrets import scan

    return scan(table(spark, sf_dir, "documents"))


# One round: the nearest centroid of every vector, then the exact floor of the mean; an empty centroid stays.
_ROUND = """
    a{0} AS (SELECT vec_id, v, c, d FROM (
        SELECT vec_id, v, c, d, row_number() OVER (PARTITION BY place_in ORDER BY d, c) AS place FROM (
            SELECT place_in, vec_id, v, c, list_sum(list_transform(range(1, 65), lambda j: (v[j] - m[j]) * (v[j] - m[j])))::BIGINT AS d FROM x CROSS JOIN c{0}))
        WHERE place = 1),
    s{0} AS (SELECT c, j, sum(y)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(v) AS y, unnest(range(1, 65)) AS j FROM a{0}) GROUP BY c, j),
    f{0} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS m FROM s{0} GROUP BY c),
    c{1} AS (SELECT c{0}.c, coalesce(f{0}.m, c{0}.m) AS m FROM c{0} LEFT JOIN f{0} ON f{0}.c = c{0}.c)"""


@query(
    sql="""
    WITH x AS (SELECT row_number() OVER () AS place_in, vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64),
    c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v AS m FROM x QUALIFY c < 16),"""
    + ",".join(_ROUND.format(n, n + 1) for n in range(4))
    + """
    SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
        sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM a3 JOIN c3 USING (c)
    """
)
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallygrid.llm.centroids import cluster, with_inertia

    return with_inertia(*cluster(table(spark, sf_dir, "embeddings")))


@query(
    sql="""
    WITH p AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
    total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
    f AS (
        SELECT lang, size, phrase, count(*) AS a FROM (
            SELECT lang, size, array_to_string(ws[i : i + size - 1], ' ') AS phrase
            FROM (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM w CROSS JOIN (SELECT unnest(range(1, 6)) AS size)))
        GROUP BY ALL HAVING count(*) >= 100),
    cand AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE size > 1),
    cut AS (SELECT lang, phrase, ws, a, size, unnest(range(1, size)) AS k FROM cand),
    scored AS (
        SELECT cut.lang, cut.phrase, cut.a, k, x.a AS l, y.a AS r, n, ((1000::HUGEINT * cut.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
        FROM cut JOIN total USING (lang)
        JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(ws[1:k], ' ') JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(ws[k + 1 : cut.size], ' ')),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (
        SELECT DISTINCT lang, a, array_to_string(ws[i : i + many - 1], ' ') AS phrase
        FROM (SELECT lang, a, ws, many, unnest(range(1, size - many + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS many FROM cand))),
    ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM best ANTI JOIN inside USING (lang, a, phrase))
    SELECT * FROM ranked WHERE rank <= 2000
    """
)
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallygrid.llm.phrases import collocations, first_of_each_lang

    return first_of_each_lang(collocations(table(spark, sf_dir, "documents"))).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query()
def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tallygrid.llm.pieces import encode_pieces

    return encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
