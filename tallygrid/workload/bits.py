"""Shots: bit vectors, classification, detector rates and parities on the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.functions import bits as B
from tallygrid.operators import checks, combine as C, compare, detectors as D, grid, shots as S
from tallygrid.plans import collect as P
from tallygrid.session import broadcast_if_small
from tallygrid.workload import query
from tallygrid.workload.views import NUM_DET, NUM_OBS, SHOTS_SQL, shots, table, tasks

WITH = "WITH " + SHOTS_SQL


def task_shots(spark, sf_dir):
    embeddings = table(spark, sf_dir, "embeddings")
    return S.with_tasks(shots(embeddings), tasks(embeddings), derived=True)


CLASSIFIED = """
    SELECT task_id, CAST(count(*) AS BIGINT) AS shots,
           CAST(count(*) FILTER (WHERE discarded) AS BIGINT) AS discards,
           CAST(count(*) FILTER (WHERE NOT discarded AND (m0 OR m1)) AS BIGINT) AS errors,
           CAST(sum(len(det)) AS BIGINT) AS detectors_checked, CAST(sum(n_events) AS BIGINT) AS detection_events
    FROM labelled GROUP BY task_id"""


@query(WITH + CLASSIFIED)
def classify_shots(spark, sf_dir):
    """Discards, errors and detection events per task."""
    return S.classify_shots(task_shots(spark, sf_dir))


@query(WITH + CLASSIFIED)
def classify_packed(spark, sf_dir):
    """The same on packed bytes, by masks, differences and bit counts of whole words."""
    rows = task_shots(spark, sf_dir)
    names = [c for c in ("det", "obs", "pred", "postselection_mask", "postselected_obs_mask") if c in rows.columns]
    packed = {c: F.when(F.col(c).isNotNull(), B.to_binary(B.pack_bits(F.col(c)))) for c in names}
    return S.classify_packed(rows.withColumns({"num_det": F.size("det"), "num_obs": F.size("obs"), **packed}))


@query(WITH + CLASSIFIED)
def classify_joined_predictions(spark, sf_dir):
    """The same with observations and predictions in two tables."""
    rows = task_shots(spark, sf_dir)
    predictions = shots(table(spark, sf_dir, "embeddings")).select("task_id", "shot_id", "pred", "pred_discard")
    return S.classify_shots(S.join_predictions(rows.drop("pred", "pred_discard"), predictions))


@query(WITH + """
    SELECT task_id, 'obs_mistake_mask=' || CASE WHEN m0 THEN 'E' ELSE '_' END || CASE WHEN m1 THEN 'E' ELSE '_' END AS counter,
           CAST(count(*) AS BIGINT) AS n
    FROM labelled WHERE NOT discarded AND (m0 OR m1) GROUP BY ALL""")
def error_combos(spark, sf_dir):
    """A5: errors per pattern of mispredicted observables."""
    return S.error_combos(task_shots(spark, sf_dir))


@query(WITH + """,
    counted AS (
      SELECT task_id, 'detectors_checked' AS counter, CAST(sum(len(det)) AS BIGINT) AS n FROM labelled GROUP BY task_id
      UNION ALL SELECT task_id, 'detection_events', CAST(sum(n_events) AS BIGINT) FROM labelled GROUP BY task_id
      UNION ALL
      SELECT task_id, 'obs_mistake_mask=' || CASE WHEN m0 THEN 'E' ELSE '_' END || CASE WHEN m1 THEN 'E' ELSE '_' END, CAST(count(*) AS BIGINT)
      FROM labelled WHERE NOT discarded AND (m0 OR m1) GROUP BY ALL)
    SELECT * FROM counted""")
def shot_counters(spark, sf_dir):
    """A3, A4, A5: all counters of a task in the long counter form."""
    return S.shot_counters(task_shots(spark, sf_dir))


@query(WITH + """
    SELECT task_id, round(sum(n_events) / sum(len(det)), 6) AS event_rate FROM labelled GROUP BY task_id""")
def event_rates(spark, sf_dir):
    """Detection events per checked detector, read from the counter map."""
    long = S.shot_counters(task_shots(spark, sf_dir))
    maps = C.counters_to_map(long, "task_id")
    return maps.select("task_id", F.round(C.event_rate(), 6).alias("event_rate"))


LONG = WITH + """,
    fired AS (SELECT task_id, unnest(range(len(det))) AS det_id, unnest(det) AS f FROM shots),
    rates AS (SELECT task_id, det_id, CAST(count(*) AS BIGINT) AS shots, CAST(count(*) FILTER (WHERE f) AS BIGINT) AS fired,
                     count(*) FILTER (WHERE f) / count(*) AS rate
              FROM fired GROUP BY task_id, det_id)
"""


@query(LONG + "SELECT task_id, CAST(det_id AS BIGINT) AS det_id, shots, fired, round(rate, 6) AS rate FROM rates")
def detector_rates(spark, sf_dir):
    """Share of shots in which each detector fired."""
    rates = S.detector_rates(shots(table(spark, sf_dir, "embeddings")))
    return rates.withColumn("rate", F.round("rate", 6))


@query(LONG + """
    SELECT task_id, round(min(rate), 6) AS min_rate, round(max(rate), 6) AS max_rate, CAST(sum(fired) AS BIGINT) AS events
    FROM rates GROUP BY task_id""")
def detector_rate_range(spark, sf_dir):
    """Smallest and largest detector rate, and all events."""
    spread = S.rate_range(S.detector_rates(shots(table(spark, sf_dir, "embeddings"))))
    return spread.select("task_id", F.round("min_rate", 6).alias("min_rate"), F.round("max_rate", 6).alias("max_rate"), "events")


PACKED = WITH + """,
    packed AS (
      SELECT shot_id, det, list_transform(range(0, 8), lambda k:
               CAST(list_sum(list_transform(range(0, 8), lambda j: CASE WHEN coalesce(det[8 * k + j + 1], FALSE) THEN 1 << j ELSE 0 END)) AS INTEGER)) AS bytes
      FROM shots)
"""


@query(PACKED + """
    SELECT shot_id, array_to_string(list_transform(bytes, lambda x: printf('%02X', x)), '') AS packed,
           CAST(len(list_filter(det, lambda x: x)) AS BIGINT) AS events
    FROM packed""")
def pack_bits(spark, sf_dir):
    """Detectors as little-endian bytes (60 bits in 8 bytes), and their number set."""
    packed = B.pack_bits(F.col("det"))
    return shots(table(spark, sf_dir, "embeddings")).select(
        "shot_id", F.hex(B.to_binary(packed)).alias("packed"), B.popcount_bytes(packed).alias("events")
    )


@query(WITH + """
    SELECT shot_id, array_to_string(list_transform(det, lambda x: CASE WHEN x THEN '1' ELSE '0' END), '') AS bits FROM shots""")
def unpack_bits(spark, sf_dir):
    """Packed BINARY back to the first 60 bits."""
    packed = shots(table(spark, sf_dir, "embeddings")).select("shot_id", B.to_binary(B.pack_bits(F.col("det"))).alias("packed"))
    bits = F.transform(B.unpack_binary(F.col("packed"), NUM_DET), lambda b: b.cast("int").cast("string"))
    return packed.select("shot_id", F.array_join(bits, "").alias("bits"))


@query(WITH + """
    SELECT task_id, CAST(count(*) AS BIGINT) AS shots, CAST(count(*) FILTER (WHERE n_events > 0 OR shot_id % 50 = 0) AS BIGINT) AS discards
    FROM labelled GROUP BY task_id""")
def postselect_all(spark, sf_dir):
    """Every detector post-selected by an all-ones mask."""
    rows = shots(table(spark, sf_dir, "embeddings")).withColumn("postselection_mask", B.full_mask(F.size("det")))
    return S.classify_shots(rows).select("task_id", "shots", "discards")


REFERENCE = WITH + """,
    reference AS (SELECT task_id, arg_min(det, shot_id) AS ref_det, arg_min(obs, shot_id) AS ref_obs FROM shots GROUP BY task_id),
    flips AS (
      SELECT shots.*,
             len(list_filter(det, lambda x: x)) AS det_raw,
             len(list_filter(list_zip(det, ref_det), lambda z: z[1] <> z[2])) AS det_ref,
             len(list_filter(obs, lambda x: x)) AS obs_raw,
             len(list_filter(list_zip(obs, ref_obs), lambda z: z[1] <> z[2])) AS obs_ref
      FROM shots JOIN reference USING (task_id))
"""


def referenced_shots(spark, sf_dir):
    """The shot with the lowest id of a task stands for its noiseless reference."""
    rows = shots(table(spark, sf_dir, "embeddings"))
    lowest = broadcast_if_small(rows.groupBy("task_id").agg(F.min("shot_id").alias("shot_id")), derived=True)
    reference = rows.join(lowest, ["task_id", "shot_id"]).select("task_id", F.col("det").alias("ref_det"), F.col("obs").alias("ref_obs"))
    return rows.join(broadcast_if_small(reference, derived=True), "task_id")


@query(REFERENCE + "SELECT task_id, shot_id, CAST(CASE WHEN shot_id % 2 = 0 THEN det_ref ELSE det_raw END AS BIGINT) AS events FROM flips")
def reference_xor(spark, sf_dir):
    """Detectors against the reference shot where the flag is set, as sampled elsewhere."""
    det = S.apply_reference(F.col("det"), F.col("ref_det"), F.col("shot_id") % 2 == 0)
    return referenced_shots(spark, sf_dir).select("task_id", "shot_id", B.popcount(det).alias("events"))


FLAGS = REFERENCE + """,
    t AS (SELECT CAST(sum(det_raw) AS BIGINT) AS dr, CAST(sum(det_ref) AS BIGINT) AS dx,
                 CAST(sum(obs_raw) AS BIGINT) AS obr, CAST(sum(obs_ref) AS BIGINT) AS obx FROM flips)
"""


@query(FLAGS + """
    SELECT FALSE AS use_ref_det, FALSE AS use_ref_obs, dr AS det_total, obr AS obs_total FROM t
    UNION ALL SELECT FALSE, TRUE, dr, obx FROM t UNION ALL SELECT TRUE, FALSE, dx, obr FROM t UNION ALL SELECT TRUE, TRUE, dx, obx FROM t""")
def flag_matrix(spark, sf_dir):
    """Event totals under the four reference settings, in one pass."""
    return compare.flag_matrix(referenced_shots(spark, sf_dir), "ref_det", "ref_obs")


@query(FLAGS + """
    SELECT FALSE AS use_ref_det, dr AS false_det, obr AS false_obs, dr AS true_det, obx AS true_obs FROM t
    UNION ALL SELECT TRUE, dx, obr, dx, obx FROM t""")
def flag_report(spark, sf_dir):
    """The matrix with one column per observable setting."""
    return compare.flag_report(compare.flag_matrix(referenced_shots(spark, sf_dir), "ref_det", "ref_obs"))


PARITY = "WITH " + SHOTS_SQL + """,
    parity AS (
      SELECT task_id, shot_id, unnest(list_transform(range(0, 32), lambda i: b[i + 1] <> b[i + 33])) AS fired, unnest(range(0, 32)) AS id
      FROM bits)
"""


def parity_targets(embeddings):
    """Detector i of every task names measurements i and i + 32 of 64, counted from the end."""
    ids = F.explode(F.sequence(F.lit(0), F.lit(31))).alias("id")
    per_task = embeddings.select(F.col("label").cast("string").alias("task_id")).distinct()
    return per_task.select("task_id", F.lit("det").alias("kind"), ids).select(
        "task_id", "kind", "id", F.explode(F.array(F.col("id") - 64, F.col("id") - 32)).alias("rec_offset")
    )


def measured_shots(embeddings):
    return embeddings.select(
        F.col("label").cast("string").alias("task_id"), F.col("vec_id").alias("shot_id"),
        F.transform("embedding", lambda x: x > 0).alias("measured"),
    )


@query(PARITY + """
    SELECT task_id, shot_id, string_agg(CASE WHEN fired THEN '1' ELSE '0' END, '' ORDER BY id) AS det FROM parity GROUP BY ALL""")
def detector_parity(spark, sf_dir):
    """Detectors as parities of the measurements they name, computed in the row."""
    embeddings = table(spark, sf_dir, "embeddings")
    evaluated = D.evaluate(measured_shots(embeddings), D.task_targets(parity_targets(embeddings), 64))
    return evaluated.select("task_id", "shot_id", F.array_join(F.transform("det", lambda b: b.cast("int").cast("string")), "").alias("det"))


@query(PARITY + "SELECT task_id, shot_id, 'det' AS kind, CAST(id AS INTEGER) AS id, fired FROM parity")
def detector_parity_long(spark, sf_dir):
    """The same from one row per measurement."""
    embeddings = table(spark, sf_dir, "embeddings")
    long = measured_shots(embeddings).select("task_id", "shot_id", F.posexplode("measured").alias("idx", "flag"))
    return D.evaluate_long(long.withColumn("bit", F.col("flag").cast("int")), parity_targets(embeddings), 64)


@query("WITH " + SHOTS_SQL + """,
    rounds AS (SELECT task_id, shot_id, label % 5 + 1 AS K, b FROM bits),
    checked AS (
      SELECT task_id, shot_id, K, b,
             len(list_filter(range(0, 4 * K), lambda i: b[5 * (i // 4) + i % 4 + 2] <> b[5 * K + i + 1])) AS fired,
             len(list_filter(range(0, K), lambda r: b[5 * r + 1])) AS flips
      FROM rounds)
    SELECT task_id, CAST(count(*) AS BIGINT) AS shots, CAST(count(*) FILTER (WHERE fired > 0) AS BIGINT) AS discards,
           CAST(count(*) FILTER (WHERE fired = 0 AND flips > 0) AS BIGINT) AS errors,
           CAST(sum(4 * K) AS BIGINT) AS detectors_checked, CAST(sum(fired) AS BIGINT) AS detection_events
    FROM checked GROUP BY task_id""")
def sequence_outcomes(spark, sf_dir):
    """Instruction text to detector definitions to outcomes.

    Label l runs l % 5 + 1 rounds, measured by the first 9K elements; all detectors are post-selected.
    """
    embeddings = table(spark, sf_dir, "embeddings")
    k = (F.col("label") % 5 + 1).cast("int")
    texts = embeddings.select("label").distinct().select(
        F.col("label").cast("string").alias("task_id"), k.alias("K"), grid.sequence_text(k, F.lit(0.001)).alias("text")
    )
    targets = D.parse_targets(texts).join(texts.select("task_id", "K"), "task_id")
    rows = D.evaluate(measured_shots(embeddings), D.task_targets(targets, F.col("K") * 9))
    silent = F.transform("obs", lambda _: F.lit(False))
    return S.classify_shots(rows.withColumn("pred", silent).withColumn("postselection_mask", B.full_mask(F.size("det"))))


@query(WITH + f"""
    SELECT task_id, shot_id, rule FROM (
      SELECT *, unnest([
        CASE WHEN len(det) <> {NUM_DET} - (CASE WHEN shot_id % 20 = 0 THEN 1 ELSE 0 END) THEN 'detector count' END,
        CASE WHEN len(obs) <> {NUM_OBS} THEN 'observable count' END,
        CASE WHEN len(pred) - (CASE WHEN shot_id % 30 = 0 THEN 1 ELSE 0 END) < {NUM_OBS} THEN 'too few predictions' END]) AS rule
      FROM shots) WHERE rule IS NOT NULL""")
def shot_violations(spark, sf_dir):
    """shots whose vectors do not have the declared sizes (some are declared wrong, some cut)."""
    rows = shots(table(spark, sf_dir, "embeddings"))
    short = F.when(F.col("shot_id") % 30 == 0, F.slice("pred", 1, NUM_OBS - 1)).otherwise(F.col("pred"))
    declared = F.lit(NUM_DET) - F.when(F.col("shot_id") % 20 == 0, 1).otherwise(0)
    return checks.violations(
        rows.withColumn("pred", short), ["task_id", "shot_id"], checks.prediction_rules(F.lit(NUM_OBS), declared)
    )


@query(WITH + """
    SELECT task_id, shot_id, unnest(list_filter([
        CASE WHEN label = 3 THEN 'unknown task' END,
        CASE WHEN shot_id % 30 = 0 THEN 'no prediction' END,
        CASE WHEN shot_id % 30 = 1 THEN 'too few predictions' END,
        CASE WHEN shot_id % 30 = 2 THEN 'too many predictions' END], lambda x: x IS NOT NULL)) AS problem
    FROM shots""")
def prediction_violations(spark, sf_dir):
    """Shots of an unknown task, and predictions that are missing, cut, or longer than one byte more."""
    embeddings = table(spark, sf_dir, "embeddings")
    rows, which = shots(embeddings), F.col("shot_id") % 30
    long = F.concat("pred", F.array_repeat(F.lit(False), 20))
    damaged = F.when(which == 0, None).when(which == 1, F.slice("pred", 1, NUM_OBS - 1)).when(which == 2, long).otherwise(F.col("pred"))
    predictions = rows.select("task_id", "shot_id", damaged.alias("pred")).filter("pred IS NOT NULL")
    joined = S.join_predictions(rows.drop("pred", "pred_discard"), predictions)
    return S.shot_problems(joined, tasks(embeddings).filter("task_id <> '3'"))


@query(WITH + CLASSIFIED)
def packed_predictions(spark, sf_dir):
    """F2, P10: shots whose vectors are packed bytes; a bit in the byte after the observables says that the decoder gave up."""
    rows = task_shots(spark, sf_dir)
    flag = F.when(F.col("pred_discard"), F.lit(4)).otherwise(F.lit(0))
    packed = rows.select(
        "task_id", "shot_id", "postselection_mask", "postselected_obs_mask",
        B.to_binary(B.pack_bits(F.col("det"))).alias("det"), B.to_binary(B.pack_bits(F.col("obs"))).alias("obs"),
        B.to_binary(F.concat(B.pack_bits(F.col("pred")), F.array(flag))).alias("pred"),
    )
    return S.classify_shots(S.unpack_shots(packed, NUM_DET, NUM_OBS))


@query(WITH + """,
    counted AS (
      SELECT task_id, CASE WHEN label % 2 = 0 THEN 'decoder0' ELSE 'decoder1' END AS decoder,
             CAST(count(*) AS BIGINT) AS shots, CAST(count(*) FILTER (WHERE discarded) AS BIGINT) AS discards,
             CAST(count(*) FILTER (WHERE NOT discarded AND (m0 OR m1)) AS BIGINT) AS errors,
             CAST(sum(len(det)) AS BIGINT) AS checked, CAST(sum(n_events) AS BIGINT) AS events
      FROM labelled GROUP BY ALL),
    combos AS (
      SELECT task_id, 'obs_mistake_mask=' || CASE WHEN m0 THEN 'E' ELSE '_' END || CASE WHEN m1 THEN 'E' ELSE '_' END AS counter, count(*) AS n
      FROM labelled WHERE NOT discarded AND (m0 OR m1) GROUP BY ALL),
    named AS (
      SELECT task_id, string_agg(',"' || counter || '":' || CAST(n AS VARCHAR), '' ORDER BY counter) AS more FROM combos GROUP BY task_id)
    SELECT shots, errors, discards, CAST(0 AS DOUBLE) AS seconds, decoder, task_id AS strong_id, 'm' || task_id AS json_metadata,
           '{"detection_events":' || CAST(events AS VARCHAR) || ',"detectors_checked":' || CAST(checked AS VARCHAR) || coalesce(more, '') || '}' AS custom_counts
    FROM counted LEFT JOIN named USING (task_id)""")
def collect_shot_table(spark, sf_dir):
    """Counter records, with the columns of stats files, of shots that exist as a table."""
    embeddings = table(spark, sf_dir, "embeddings")
    described = tasks(embeddings).withColumn("json_metadata", F.concat(F.lit("m"), "task_id"))
    return P.collect_shots(shots(embeddings), described).drop(S.CHECKED, S.EVENTS)


@query("""
    WITH t AS (SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS task_id, p_size % 4 AS kind, p_size % 7 + 2 AS n FROM part)
    SELECT task_id, CASE kind WHEN 0 THEN 'repeat blocks are not counted through' WHEN 1 THEN 'a measurement follows a detector' END AS problem,
           CASE WHEN kind >= 2 THEN '0|' || CASE WHEN kind = 3 THEN '' ELSE CAST(n - 2 AS VARCHAR) END || '|' || CAST(n - 1 AS VARCHAR) END AS detectors,
           CASE WHEN kind >= 2 THEN repeat('|', CAST(n AS INTEGER)) || '0' END AS observables
    FROM t""")
def detector_layout(spark, sf_dir):
    """Detectors and observables keep the place of their id, empty ones included; text that cannot be read is flagged."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("task_id"), (F.col("p_size") % 4).alias("kind"), (F.col("p_size") % 7 + 2).cast("int").alias("n"))
    rec = lambda back: F.concat(F.lit(" rec[-"), back.cast("string"), F.lit("]"))
    lines = F.array(
        F.concat(F.lit("M "), F.array_join(F.sequence(F.lit(0), F.col("n") - 1), " ")),
        F.when(F.col("kind") == 0, F.lit("REPEAT 2 {")).otherwise(F.lit("")),
        F.concat(F.lit("DETECTOR"), rec(F.col("n"))),
        F.when(F.col("kind") == 1, F.lit("MR 0")).otherwise(F.lit("")),
        F.concat(F.lit("DETECTOR"), F.when(F.col("kind") == 3, F.lit("")).otherwise(rec(F.lit(2)))),
        F.concat(F.lit("DETECTOR"), rec(F.lit(1))),
        F.concat(F.lit("OBSERVABLE_INCLUDE("), F.col("n").cast("string"), F.lit(")"), rec(F.col("n"))),
    )
    texts = part.withColumn("text", F.array_join(lines, "\n"))
    flagged = D.unsupported_texts(texts)
    good = texts.join(flagged, "task_id", "left_anti")
    targets = D.parse_targets(good).join(good.select("task_id", "n"), "task_id")
    show = lambda c: F.array_join(F.transform(c, lambda x: F.array_join(x, ",")), "|")
    layout = D.task_targets(targets, F.col("n")).select("task_id", show("det_positions").alias("detectors"), show("obs_positions").alias("observables"))
    return texts.select("task_id").join(flagged, "task_id", "left").join(layout, "task_id", "left")
