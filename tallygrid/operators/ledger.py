"""Run accounting: wall time, compute hours, cost, speed-up, stragglers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_ledger(jobs: DataFrame, baseline: str, price_per_hour: float) -> DataFrame:
    """One row per run from its jobs `(run_id, job_id, start_s, end_s, seconds)`."""
    runs = jobs.groupBy("run_id").agg(
        F.count("*").alias("instances"),
        (F.max("end_s") - F.min("start_s")).alias("wall_seconds"),
        (F.sum("seconds") / 3600).alias("compute_hours"),
        F.max("seconds").alias("slowest_seconds"),
        F.max_by("job_id", F.struct("seconds", -F.col("job_id"))).alias("slowest_job"),
        F.try_divide(F.max("seconds"), F.avg("seconds")).alias("imbalance"),
    )
    every_run = Window.partitionBy()  # one row per run
    base = F.max(F.when(F.col("run_id") == baseline, F.col("wall_seconds"))).over(every_run)
    return runs.select(
        "*",
        (F.col("compute_hours") * price_per_hour).alias("cost"),
        (F.col("wall_seconds") - F.col("slowest_seconds")).alias("overhead_seconds"),
        F.try_divide(base, F.col("wall_seconds")).alias("speed_up"),
    )
