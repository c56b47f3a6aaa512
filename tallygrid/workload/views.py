"""Sweep-shaped views of the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.operators.grid import MEMORY_RATES, SEQUENCE_RATES

# Limits that end some experiments of the views by errors and others by shots.
MAX_SHOTS, MAX_ERRORS = 40, 8
MIN_ERRORS = 5

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of a task whose work is many times what the row takes in its file.
TASK_ROWS = 10_000


def spread(rows: DataFrame) -> DataFrame:
    """The rows of a small file dealt evenly to as many tasks as they need; the file alone would be one task."""
    return rows.repartition(max(1, -(-rows.count() // TASK_ROWS)))


def pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


# ---- fragments: events per user and day --------------------------------------

def user() -> Column:
    return F.col("user_id")


def user_id_text() -> Column:
    return F.sha2(F.concat(F.lit("u"), user().cast("string")), 256)


def metadata_text() -> Column:
    return F.concat(
        F.lit('{"d":"'), F.col("d").cast("string"),
        F.lit('","p":"'), F.col("p_text"),
        F.lit('","type":"'), F.col("kind"), F.lit('"}'),
    )


def fragments(events: DataFrame, *extra: str) -> DataFrame:
    """One counter fragment per user and day (and per `extra` column)."""
    is_type = F.col("event_type")
    daily = events.groupBy(user(), F.to_date("ts").alias("day"), *extra).agg(
        F.count("*").alias("shots"),
        F.count_if(is_type == "error").alias("errors"),
        F.count_if(is_type == "signup").alias("discards"),
        F.sum("value").alias("seconds"),
    )
    return (
        daily.withColumn("decoder", F.when(user() % 2 == 0, "m").otherwise("f"))
        .withColumn("strong_id", user_id_text())
        .withColumn("d", 3 + 2 * (user() % 6))
        .withColumn("p", pick(MEMORY_RATES, user() % 7))
        .withColumn("p_text", pick([str(r) for r in MEMORY_RATES], user() % 7))
        .withColumn("kind", F.when(user() % 3 == 0, "memory").otherwise("transport"))
        .withColumn("json_metadata", metadata_text())
    )


def day_counts(events: DataFrame, *extra: str) -> DataFrame:
    """A counter map per user and day: events of each type, zero counts left out."""
    pairs = []
    for name in EVENT_TYPES:
        pairs += [F.lit(name), F.count_if(F.col("event_type") == name)]
    return (
        events.groupBy(user(), F.to_date("ts").alias("day"), *extra)
        .agg(F.create_map(*pairs).alias("all_counts"))
        .withColumn("strong_id", user_id_text())
        .withColumn("custom_counts", F.map_filter("all_counts", lambda _, n: n > 0))
        .drop("all_counts")
    )


def fragment_sql(extra: str = "", where: str = "") -> str:
    """The same fragments as a chain of SQL views ending in `fragments`."""
    rates = ", ".join(str(r) for r in MEMORY_RATES)
    texts = ", ".join(f"'{r}'" for r in MEMORY_RATES)
    return f"""
    WITH daily AS (
      SELECT user_id, CAST(ts AS DATE) AS day {extra},
             CAST(count(*) AS BIGINT) AS shots,
             CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS errors,
             CAST(count(*) FILTER (WHERE event_type = 'signup') AS BIGINT) AS discards,
             sum(value) AS seconds
      FROM events {where} GROUP BY ALL),
    named AS (
      SELECT *, CASE WHEN user_id % 2 = 0 THEN 'm' ELSE 'f' END AS decoder,
             sha256('u' || CAST(user_id AS VARCHAR)) AS strong_id,
             3 + 2 * (user_id % 6) AS d,
             CAST(([{rates}])[user_id % 7 + 1] AS DOUBLE) AS p,
             ([{texts}])[user_id % 7 + 1] AS p_text,
             CASE WHEN user_id % 3 = 0 THEN 'memory' ELSE 'transport' END AS kind
      FROM daily),
    fragments AS (
      SELECT *, '{{"d":"' || CAST(d AS VARCHAR) || '","p":"' || p_text || '","type":"' || kind || '"}}' AS json_metadata
      FROM named)
    """


TOTALS_SQL = """
    totals AS (
      SELECT strong_id, CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(errors) AS BIGINT) AS errors,
             CAST(sum(discards) AS BIGINT) AS discards, sum(seconds) AS seconds,
             min(decoder) AS decoder, min(json_metadata) AS json_metadata
      FROM fragments GROUP BY strong_id)
"""


# ---- shots: signs of the embedding elements -----------------------------------

NUM_DET, NUM_OBS = 60, 2


def shots(embeddings: DataFrame) -> DataFrame:
    """One shot per vector: a bit per element, split in detectors, observables, predictions."""
    bits = F.transform("embedding", lambda x: x > 0)
    return embeddings.select(
        F.col("label").cast("string").alias("task_id"),
        F.col("vec_id").alias("shot_id"),
        F.slice(bits, 1, NUM_DET).alias("det"),
        F.slice(bits, NUM_DET + 1, NUM_OBS).alias("obs"),
        F.slice(bits, NUM_DET + NUM_OBS + 1, NUM_OBS).alias("pred"),
        (F.col("vec_id") % 50 == 0).alias("pred_discard"),
    )


def tasks(embeddings: DataFrame) -> DataFrame:
    """One task per label: detectors 0 and 1 post-selected, but none for label 9; observable 1 for odd labels."""
    two = F.concat(F.array_repeat(F.lit(True), 2), F.array_repeat(F.lit(False), NUM_DET - 2))
    label = F.col("label")
    return embeddings.select(label).distinct().select(
        label.cast("string").alias("task_id"),
        F.concat(F.lit("decoder"), (label % 2).cast("string")).alias("decoder"),
        F.when(label != 9, two).alias("postselection_mask"),
        F.when(label % 2 == 1, F.array(F.lit(False), F.lit(True))).alias("postselected_obs_mask"),
    )


SHOTS_SQL = f"""
    bits AS (
      SELECT CAST(label AS VARCHAR) AS task_id, label, vec_id AS shot_id,
             list_transform(embedding, lambda x: x > 0) AS b FROM embeddings),
    shots AS (
      SELECT task_id, label, shot_id, b[1:{NUM_DET}] AS det,
             b[{NUM_DET + 1}:{NUM_DET + NUM_OBS}] AS obs, b[{NUM_DET + NUM_OBS + 1}:{NUM_DET + 2 * NUM_OBS}] AS pred
      FROM bits),
    labelled AS (
      SELECT *, obs[1] <> pred[1] AS m0, obs[2] <> pred[2] AS m1,
             len(list_filter(det, lambda x: x)) AS n_events,
             (label <> 9 AND (det[1] OR det[2])) OR shot_id % 50 = 0
               OR (label % 2 = 1 AND obs[2] <> pred[2]) AS discarded
      FROM shots)
"""


# ---- backends: two thresholds on each line item --------------------------------



def fired_a() -> Column:
    return F.col("l_discount") >= 0.05


def fired_b() -> Column:
    return F.col("l_tax") >= 0.04


# ---- sweep items: parts ---------------------------------------------------------


def items(part: DataFrame) -> DataFrame:
    """One experiment per part: brand is the sweep, size the measured seconds."""
    return part.select(
        F.col("p_brand").alias("sweep"), "p_partkey", F.col("p_size").cast("double").alias("seconds"),
        F.concat_ws("/", F.lit("sweeps"), "p_brand", F.concat(F.lit("part_"), F.col("p_partkey").cast("string"), F.lit(".circuit"))).alias("path"),
    )


ITEMS_SQL = """
    items AS (
      SELECT p_brand AS sweep, p_partkey, CAST(p_size AS DOUBLE) AS seconds,
             'sweeps/' || p_brand || '/part_' || CAST(p_partkey AS VARCHAR) || '.circuit' AS path
      FROM part)
"""


def rounds(part: DataFrame) -> DataFrame:
    """Sequence parameters per part: one to five rounds, one of the five standard rates."""
    return part.select(
        "p_partkey",
        (F.col("p_size") % 5 + 1).alias("K"),
        pick(SEQUENCE_RATES, F.col("p_partkey") % 5).alias("p"),
    )


ROUNDS_SQL = f"""
    rounds AS (
      SELECT p_partkey, CAST(p_size % 5 + 1 AS INTEGER) AS K,
             CAST(([{", ".join(str(r) for r in SEQUENCE_RATES)}])[p_partkey % 5 + 1] AS DOUBLE) AS p
      FROM part)
"""
