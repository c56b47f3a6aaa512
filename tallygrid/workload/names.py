"""Names, ids and instruction text of parts and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.functions import ids, layout as L, names as N
from tallygrid.operators import detectors as D, grid, profile as P
from tallygrid.session import broadcast_if_small
from tallygrid.sources.catalogue import split_by_name
from tallygrid.workload import query
from tallygrid.workload.views import ROUNDS_SQL, rounds, spread, table

NAMED = """
    WITH named AS (
      SELECT p_partkey,
             'sweeps/' || CASE WHEN p_partkey % 50 = 0 THEN 'd' ELSE 'd=' END || CAST(p_size AS VARCHAR) || ',p=' || CAST(p_retailprice AS VARCHAR)
               || ',b=X,type=' || p_type || '.circuit' AS path
      FROM part)
"""


def named_parts(spark, sf_dir):
    """A comma name per part; every fiftieth has lost its first `=`."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(
            F.lit("sweeps/"), F.when(F.col("p_partkey") % 50 == 0, "d").otherwise("d="), F.col("p_size").cast("string"),
            F.lit(",p="), F.col("p_retailprice").cast("string"), F.lit(",b=X,type="), F.col("p_type"), F.lit(".circuit"),
        ).alias("path"),
    )


@query(NAMED + """
    SELECT part.p_partkey, CAST(p_size AS INTEGER) AS d, p_retailprice AS p, 'X' AS basis, p_type AS kind,
           replace(replace(path, 'sweeps/', ''), '.circuit', '') AS stem, p_type || ' d=' || CAST(p_size AS VARCHAR) AS series
    FROM part JOIN named USING (p_partkey) WHERE part.p_partkey % 50 <> 0""")
def parse_names(spark, sf_dir):
    """Comma names to typed columns."""
    good, _ = split_by_name(named_parts(spark, sf_dir), N.parse_comma_name, ["d", "p"])
    d = N.meta_value("meta", "d", "int")
    kind = N.meta_value("meta", "type")
    return good.select(
        "p_partkey", d.alias("d"), N.meta_value("meta", "p", "double").alias("p"), N.meta_value("meta", "b").alias("basis"),
        kind.alias("kind"), N.stem(F.col("path")).alias("stem"), N.series_label(kind, d).alias("series"),
    )


@query(NAMED + "SELECT p_partkey, path FROM named WHERE p_partkey % 50 = 0")
def quarantined_names(spark, sf_dir):
    """Names that do not parse."""
    _, bad = split_by_name(named_parts(spark, sf_dir), N.parse_comma_name, ["d", "p"])
    return bad.select("p_partkey", "path")


@query("WITH " + ROUNDS_SQL + """
    SELECT p_partkey, K, p, 'sequence_K=' || CAST(K AS VARCHAR) || '_p=' || CAST(p AS VARCHAR) || '.circuit' AS name FROM rounds""")
def parse_sequence_names(spark, sf_dir):
    """Underscore names made from K and p, and parsed back."""
    named = rounds(table(spark, sf_dir, "part")).select("p_partkey", grid.sequence_name(F.col("K"), F.col("p"), "sequence").alias("path"))
    good, _ = split_by_name(named, N.parse_underscore_name, ["K", "p"])
    return good.select(
        "p_partkey", N.meta_value("meta", "K", "int").alias("K"), N.meta_value("meta", "p", "double").alias("p"), N.basename(F.col("path")).alias("name")
    )


@query("""
    WITH scaled AS (SELECT p_partkey, p_size / power(10, p_partkey % 8) AS p FROM part)
    SELECT p_partkey, 'd=3,p=' || CAST(p AS VARCHAR) || ',b=Z,type=memory.circuit' AS name FROM scaled""")
def memory_names(spark, sf_dir):
    """Rates over eight orders of magnitude as they stand in file names."""
    p = F.col("p_size") / F.pow(F.lit(10.0), F.col("p_partkey") % 8)
    return table(spark, sf_dir, "part").select(
        "p_partkey", grid.memory_name(F.lit(3), p, F.lit("Z"), F.lit("memory"), "circuit").alias("name")
    )


@query("""
    WITH ids AS (
      SELECT doc_id, sha256(text || chr(0) || 'dec_' || lang || chr(0) || CASE WHEN doc_id % 2 = 0 THEN 'FF' ELSE '' END) AS strong_id FROM documents)
    SELECT doc_id, strong_id, left(strong_id, 16) AS prefix FROM ids""")
def content_ids(spark, sf_dir):
    """Ids over the whole text, the decoder and the mask."""
    decoder = F.concat_ws("_", F.lit("dec"), F.col("lang"))
    strong_id = ids.content_id(F.col("text"), decoder, F.when(F.col("doc_id") % 2 == 0, F.lit("FF")))
    return table(spark, sf_dir, "documents").select(
        "doc_id", strong_id.alias("strong_id"), ids.id_prefix(strong_id).alias("prefix")
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type || '_sampler' AS decoder FROM events")
def json_metadata(spark, sf_dir):
    """A typed field of JSON metadata, and a backend key."""
    meta = N.parse_json_metadata("props")
    return table(spark, sf_dir, "events").select(
        "event_id", N.meta_value(meta, "k", "int").alias("k"), N.backend_key(F.col("event_type"), "sampler").alias("decoder")
    )


@query("WITH " + ROUNDS_SQL + """
    SELECT p_partkey, K, 5 * K AS data_bits, 4 * K AS check_bits, 9 * K AS measurements, 4 * K AS detectors, K AS observables, 12 * K AS t_count,
           round(-acos(sqrt(1.0 / 3)) / pi(), 12) AS theta
    FROM rounds""")
def sequence_layout(spark, sf_dir):
    """Sizes of the sequence of each part, and the rotation constant."""
    return rounds(table(spark, sf_dir, "part")).select("p_partkey", "K", grid.sequence_layout(F.col("K")).alias("s"), F.round(L.theta(), 12).alias("theta")).select(
        "p_partkey", "K", "s.*", "theta"
    )


OFFSETS = "WITH " + ROUNDS_SQL + """,
    bits AS (SELECT p_partkey, K, unnest(range(0, 9 * K)) AS pos FROM rounds),
    offsets AS (
      SELECT p_partkey, CAST(CASE WHEN pos < 5 * K THEN pos // 5 ELSE (pos - 5 * K) // 4 END AS INTEGER) AS round,
             CASE WHEN pos < 5 * K THEN 'data' ELSE 'check' END AS kind,
             CAST(CASE WHEN pos < 5 * K THEN pos % 5 ELSE (pos - 5 * K) % 4 END AS INTEGER) AS bit,
             CAST(pos - 9 * K AS INTEGER) AS rec_offset
      FROM bits)
"""


@query(OFFSETS + "SELECT * FROM offsets")
def record_offsets(spark, sf_dir):
    """P20: record offsets of all data and check bits."""
    return grid.record_offsets(rounds(table(spark, sf_dir, "part"))).select("p_partkey", "round", "kind", "bit", "rec_offset")


def sequence_texts(spark, sf_dir):
    """The texts of the different (K, p) cells are rendered once and joined to their parts."""
    part = rounds(table(spark, sf_dir, "part"))
    cells = part.select("K", "p").distinct()
    texts = cells.select("K", "p", grid.sequence_text(F.col("K"), F.col("p")).alias("text"))
    return spread(part).join(broadcast_if_small(texts, derived=True), ["K", "p"]).select(F.col("p_partkey").cast("string").alias("task_id"), "K", "text")


def text_sql() -> str:
    """The text by string replacement in the template of one round."""
    template = grid.ROUND_TEMPLATE.replace("{theta}", repr(L.THETA)).replace("{minus_theta}", repr(-L.THETA)).replace("\n", "\\n")
    body = f"replace(e'{template}', '{{p}}', CAST(p AS VARCHAR))"
    for i in range(5):
        body = f"replace({body}, '{{{i}}}', CAST(5 * r + {i} AS VARCHAR))"
    checks = "array_to_string(list_transform({numbers}, lambda n: CAST(n AS VARCHAR)), ' ')"
    every = checks.format(numbers="range(5 * K, 9 * K)")
    flipped = checks.format(numbers="list_filter(range(5 * K, 9 * K), lambda n: (n - 5 * K) % 4 <> 1)")
    return "WITH " + ROUNDS_SQL + f""",
    texts AS (
      SELECT p_partkey, K, array_to_string(list_concat(
        list_transform(range(0, K), lambda r: {body}),
        ['R ' || {every}, 'X ' || {flipped}, 'M ' || {every}],
        list_transform(range(0, 4 * K), lambda c: 'DETECTOR rec[' || CAST(5 * (c // 4) + c % 4 + 1 - 9 * K AS VARCHAR) || '] rec[' || CAST(c - 4 * K AS VARCHAR) || ']'),
        list_transform(range(0, K), lambda r: 'OBSERVABLE_INCLUDE(' || CAST(r AS VARCHAR) || ') rec[' || CAST(5 * r - 9 * K AS VARCHAR) || ']')), e'\\n') AS text
      FROM rounds)
    """


@query(text_sql() + "SELECT CAST(p_partkey AS VARCHAR) AS task_id, K, text FROM texts")
def sequence_text(spark, sf_dir):
    """Instruction text of each part's sequence."""
    return sequence_texts(spark, sf_dir)


@query("WITH " + ROUNDS_SQL + """
    SELECT CAST(p_partkey AS VARCHAR) AS task_id, FALSE AS has_repeat, CAST(21 * K + 3 AS BIGINT) AS n_lines, CAST(4 * K AS BIGINT) AS n_detectors,
           CAST(K AS BIGINT) AS n_observables, CAST(9 * K AS BIGINT) AS n_measurements, CAST(12 * K AS BIGINT) AS t_count, TRUE AS non_clifford
    FROM rounds""")
def instruction_profile(spark, sf_dir):
    """Line profile of the rendered texts."""
    return P.profile(sequence_texts(spark, sf_dir).drop("K")).drop("text")


@query(OFFSETS + """
    SELECT CAST(p_partkey AS VARCHAR) AS task_id, 'det' AS kind, CAST(4 * round + bit - CASE WHEN kind = 'data' THEN 1 ELSE 0 END AS INTEGER) AS id, rec_offset
    FROM offsets WHERE NOT (kind = 'data' AND bit = 0)
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'obs', round, rec_offset FROM offsets WHERE kind = 'data' AND bit = 0""")
def instruction_targets(spark, sf_dir):
    """Measurements named by the detectors and observables of the rendered texts."""
    return D.parse_targets(sequence_texts(spark, sf_dir))
