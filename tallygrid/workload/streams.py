"""Streaming queries, drained on the given tables and on files Spark wrote from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.schema import STATS_COLUMNS
from tallygrid.session import new_path
from tallygrid.sources.fragments import partition_snapshot_key
from tallygrid.streaming import collect as St, deltas as D
from tallygrid.workload import query
from tallygrid.workload.files import FRAG, SNAPSHOT_TOTALS, counter_rows, write_snapshots
from tallygrid.workload.views import TOTALS_SQL, table, user_id_text


def stream_events(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query(FRAG + "," + TOTALS_SQL + """
    SELECT strong_id, shots, errors, discards, round(seconds, 4) AS seconds, round(errors / shots, 6) AS error_rate,
           round(errors / nullif(shots - discards, 0), 6) AS err_rate, round((shots - discards) / shots, 6) AS ps_rate,
           CASE WHEN errors >= 14 THEN 'max_errors' WHEN shots >= 65 THEN 'max_shots' END AS end_reason
    FROM totals""")
def stream_combine(spark, sf_dir):
    """Counters accumulated from a stream, published with their completion state."""
    kind = F.col("event_type")
    fragments = stream_events(spark, sf_dir).select(
        user_id_text().alias("strong_id"), F.lit(1).cast("bigint").alias("shots"),
        (kind == "error").cast("bigint").alias("errors"), (kind == "signup").cast("bigint").alias("discards"),
        F.col("value").alias("seconds"),
    )
    out, checkpoint = new_path(spark, "published"), new_path(spark, "checkpoint")
    D.follow_totals(fragments, out, checkpoint).awaitTermination()
    return St.with_status(D.read_totals(spark, out), 65, 14).select(
        "strong_id", "shots", "errors", "discards", F.round("seconds", 4).alias("seconds"), "end_reason",
        *[F.round(c, 6).alias(c) for c in ("error_rate", "err_rate", "ps_rate")],
    )


@query(SNAPSHOT_TOTALS)
def stream_snapshots(spark, sf_dir):
    """T5: cumulative snapshot files as a stream, a few per trigger; the newest of each batch, summed."""
    root = write_snapshots(spark, sf_dir)
    out, checkpoint = new_path(spark, "published"), new_path(spark, "checkpoint")
    D.follow_snapshots(St.stream_raw(spark, root, files_per_trigger=8), out, checkpoint, partition_snapshot_key).awaitTermination()
    return D.read_snapshot_totals(spark, out).select("strong_id", "shots", "errors")


def write_batch(rows, root, batches):
    """The counter files of some batches, beside those that are there."""
    kept = rows.filter(F.col("batch_id").isin(batches)).select(*STATS_COLUMNS, "batch_id")
    kept.write.mode("append").partitionBy("batch_id").option("header", True).option("escape", '"').csv(root)


@query(FRAG + "," + TOTALS_SQL + " SELECT strong_id, shots, errors, CAST(2 AS BIGINT) AS runs FROM totals")
def stream_paced(spark, sf_dir):
    """Totals at a pace of one second, stopped and started again from the checkpoint when more files have come."""
    rows = counter_rows(spark, sf_dir)
    root, out, checkpoint = new_path(spark, "arriving"), new_path(spark, "published"), new_path(spark, "checkpoint")
    epochs = []
    for batches in ([0, 1, 2], [3, 4, 5, 6]):
        write_batch(rows, root, batches)
        running = D.follow_totals(St.stream_raw(spark, root), out, checkpoint, every="1 second")
        try:
            running.processAllAvailable()
            epochs.append({p["batchId"] for p in running.recentProgress if p["numInputRows"]})
        finally:
            running.stop()
    runs = sum(bool(e) for e in epochs) if not epochs[0] & epochs[1] else 0  # no epoch was run twice
    return D.read_totals(spark, out).select("strong_id", "shots", "errors", F.lit(runs).cast("long").alias("runs"))


@query(FRAG + """,
    seen AS (SELECT *, CASE WHEN user_id % 7 < 3 THEN 'first' ELSE 'second' END AS job, user_id % 7 = 5 AS bad FROM fragments)
    SELECT job, CAST(count(*) FILTER (WHERE NOT bad) AS BIGINT) AS good, CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS quarantined,
           count(DISTINCT strong_id) FILTER (WHERE NOT bad) AS experiments, CAST(sum(shots) FILTER (WHERE NOT bad) AS BIGINT) AS shots,
           CAST(sum(errors) FILTER (WHERE NOT bad) AS BIGINT) AS errors, true AS files_seen
    FROM seen GROUP BY job""")
def job_progress(spark, sf_dir):
    """Two jobs that follow their own folders, one of them with damaged rows, in one view of rows, files and totals."""
    rows, jobs = counter_rows(spark, sf_dir), {}
    rows = rows.withColumn("custom_counts", F.when(F.col("batch_id") == 5, "[1]").otherwise(F.col("custom_counts")))
    for job, batches in (("first", [0, 1, 2]), ("second", [3, 4, 5, 6])):
        root, jobs[job] = new_path(spark, job), new_path(spark, f"{job}-out")
        write_batch(rows, root, batches)
        D.follow_totals(St.stream_raw(spark, root, files_per_trigger=2), jobs[job], new_path(spark, "checkpoint")).awaitTermination()
    seen = D.job_progress(spark, jobs)
    return seen.select("job", "good", "quarantined", "experiments", "shots", "errors", ((F.col("files") >= 3) & (F.col("epochs") >= 2)).alias("files_seen"))
