"""Merged counters, batch folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.schema import STATS_COLUMNS


def write_stats(stats: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Counters in file order of `strong_id`, as Parquet or as CSV with the header of existing files."""
    columns = [c for c in STATS_COLUMNS if c in stats.columns]
    writer = stats.select(*columns).sort("strong_id").write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.format(fmt).save(path)


def counts_as_json(stats: DataFrame) -> DataFrame:
    """The counter map as the JSON text that CSV files hold."""
    return stats.withColumn("custom_counts", F.to_json("custom_counts"))


def write_batches(assigned: DataFrame, path: str, run_id: str | None = None, fmt: str = "parquet", prefix: str = "") -> None:
    """One folder per batch: `[run_id=<r>/]batch_id=<prefix><i>`.

    Only the folders written are replaced, and a run id keeps runs apart. The
    rebalance lets adaptive execution split a large batch over several files.
    """
    rows, layout = assigned, ["batch_id"]
    if prefix:
        rows = rows.withColumn("batch_id", F.concat(F.lit(prefix), F.col("batch_id").cast("string")))
    if run_id is not None:
        rows, layout = rows.withColumn("run_id", F.lit(run_id)), ["run_id", "batch_id"]
    writer = rows.hint("rebalance", "batch_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.partitionBy(*layout).format(fmt).save(path)
