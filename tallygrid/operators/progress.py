"""Stop rules, completion state, and the work that is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.operators.ordered import preceding_totals


def end_reason(shots: Column, errors: Column, max_shots: Column | int, max_errors: Column | int) -> Column:
    """Which limit is met; NULL while none is."""
    return F.when(errors >= max_errors, F.lit("max_errors")).when(shots >= max_shots, F.lit("max_shots"))


def stop_rule(fragments: DataFrame, order: list[Column | str], max_shots: int, max_errors: int, key: str = "strong_id") -> DataFrame:
    """Fragments that count: those begun before either limit was met.

    The last kept fragment may overshoot. An id may hold any share of the rows.
    """
    running = preceding_totals(fragments, key, order, ["shots", "errors"])
    return running.filter((F.col("shots_before") < max_shots) & (F.col("errors_before") < max_errors)).drop(
        "shots_before", "errors_before"
    )


def stopped_totals(kept: DataFrame, max_shots: int, max_errors: int, key: str = "strong_id") -> DataFrame:
    totals = kept.groupBy(key).agg(
        F.count("*").alias("fragments"), F.sum("shots").alias("shots"), F.sum("errors").alias("errors")
    )
    return totals.withColumn("end_reason", end_reason(F.col("shots"), F.col("errors"), max_shots, max_errors))


def shot_extremes(totals: DataFrame) -> DataFrame:
    """Smallest and largest experiment, and what ended it."""
    return totals.agg(
        F.min("shots").alias("min_shots"),
        F.min_by("end_reason", F.struct("shots", "strong_id")).alias("min_reason"),
        F.max("shots").alias("max_shots"),
        F.max_by("end_reason", F.struct("shots", "strong_id")).alias("max_reason"),
    )


def remaining_work(tasks: DataFrame, totals: DataFrame, key: str = "strong_id") -> DataFrame:
    """All tasks with what they still need, given the counters already on disk.

    `tasks` holds `max_shots` and `max_errors`; counters of earlier runs count toward
    them. A NULL limit is no limit: what remains of it is NULL while the task is open.
    """
    have = totals.select(key, F.col("shots").alias("_shots"), F.col("errors").alias("_errors"))
    shots, errors = F.coalesce("_shots", F.lit(0)), F.coalesce("_errors", F.lit(0))
    done = F.coalesce(shots >= F.col("max_shots"), F.lit(False)) | F.coalesce(errors >= F.col("max_errors"), F.lit(False))
    return (
        tasks.join(have, key, "left")
        .withColumn("remaining_shots", F.when(done, F.lit(0)).otherwise(F.col("max_shots") - shots).cast("bigint"))
        .withColumn("remaining_errors", F.when(done, F.lit(0)).otherwise(F.col("max_errors") - errors).cast("bigint"))
        .withColumn("end_reason", end_reason(shots, errors, F.col("max_shots"), F.col("max_errors")))
        .drop("_shots", "_errors")
    )


def unfinished(tasks: DataFrame, totals: DataFrame, key: str = "strong_id") -> DataFrame:
    """Tasks to run again: those whose counters meet no limit."""
    return remaining_work(tasks, totals, key).filter("end_reason is null").select(*tasks.columns)


def progress_summary(totals: DataFrame) -> DataFrame:
    """One view over all experiments: how many are open or ended, and by which limit."""
    return totals.groupBy(F.coalesce("end_reason", F.lit("open")).alias("state")).agg(
        F.count("*").alias("experiments"), F.sum("shots").alias("shots"), F.sum("errors").alias("errors")
    )
