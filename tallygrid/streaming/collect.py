"""Counters that accumulate while fragments arrive.

Counters commute, so late files need no watermark, and the state is one row per
experiment and named counter. Each trigger publishes the complete result as one
`epoch=<n>` folder; a replayed epoch overwrites itself, readers take the highest
epoch that was written to its end, and only the last few epochs are kept. A folder
of results belongs to one checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallygrid.functions.rates import error_rate, postselected_error_rate, postselection_rate
from tallygrid.operators.combine import counts_as_map, merge_entries, partial_entries
from tallygrid.operators.progress import end_reason
from tallygrid.schema import CORRUPT, STATS_RAW
from tallygrid.sources.fragments import good_rows, snapshot_key


def stream_fragments(
    spark: SparkSession,
    root: str,
    pattern: str = "*.csv",
    schema: T.StructType = STATS_RAW,
    files_per_trigger: int = 1000,
) -> DataFrame:
    """Good rows of fragment files as they appear below `root`."""
    return good_rows(stream_raw(spark, root, pattern, schema, files_per_trigger))


def stream_raw(spark: SparkSession, root: str, pattern: str = "*.csv", schema: T.StructType = STATS_RAW, files_per_trigger: int = 1000) -> DataFrame:
    """All rows of fragment files as they appear below `root`, malformed ones included."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .csv(root)
        .select("*", F.col("_metadata.file_path").alias("file_path"))
    )


def with_status(totals: DataFrame, max_shots: int, max_errors: int) -> DataFrame:
    """Rates and completion of each experiment, from its totals: independent of arrival order."""
    shots, errors, discards = F.col("shots"), F.col("errors"), F.col("discards")
    return totals.select(
        "*",
        error_rate(errors, shots).alias("error_rate"),
        postselected_error_rate(errors, shots, discards).alias("err_rate"),
        postselection_rate(shots, discards).alias("ps_rate"),
        end_reason(shots, errors, max_shots, max_errors).alias("end_reason"),
    )


# Published epochs that stay; readers of an older one have to be done by then.
KEPT_EPOCHS = 3


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def finished_epochs(spark: SparkSession, out: str) -> list[int]:
    """Epochs below a folder that carry the success marker of a finished write, from the folder names alone."""
    fs, where = _folder(spark, out)
    found = []
    for status in fs.listStatus(where) if fs.exists(where) else []:
        name = status.getPath().getName()
        if name.startswith("epoch=") and fs.exists(_folder(spark, f"{out}/{name}/_SUCCESS")[1]):
            found.append(int(name.removeprefix("epoch=")))
    return sorted(found)


def drop_old_epochs(spark: SparkSession, out: str, kept: int = KEPT_EPOCHS) -> None:
    for epoch in finished_epochs(spark, out)[:-kept]:
        fs, where = _folder(spark, f"{out}/epoch={epoch}")
        fs.delete(where, True)


def claim(spark: SparkSession, out: str, checkpoint: str) -> None:
    """Tie a folder of results to its checkpoint: another one would number its epochs anew."""
    fs, where = _folder(spark, f"{out}/_checkpoint_of")
    if fs.exists(_folder(spark, f"{out}/_checkpoint_of/_SUCCESS")[1]):  # a marker without it is what a crash left
        known = [r.value for r in spark.read.text(f"{out}/_checkpoint_of").collect()]
        if known != [checkpoint]:
            raise ValueError(f"{out} holds the epochs of checkpoint {known}, not of {checkpoint!r}")
        return
    spark.createDataFrame([(checkpoint,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/_checkpoint_of")


def start_publishing(
    result: DataFrame,
    out: str,
    checkpoint: str,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    every: str | None = None,
    kept: int = KEPT_EPOCHS,
) -> StreamingQuery:
    """Publish a streaming aggregate epoch by epoch.

    `every="60 seconds"` keeps running at that pace; without it the query drains
    what is there and stops. `finish` runs on each complete result.
    """

    def publish(frame: DataFrame, epoch: int) -> None:
        final = finish(frame) if finish else frame
        final.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        drop_old_epochs(frame.sparkSession, out, kept)

    claim(result.sparkSession, out, checkpoint)
    writer = result.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(publish)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def start_combine(fragments: DataFrame, out: str, checkpoint: str, max_shots: int, max_errors: int, every: str | None = None) -> StreamingQuery:
    """Running totals per experiment with its named counters, rates and completion state."""
    entries = partial_entries(counts_as_map(fragments))
    return start_publishing(entries, out, checkpoint, lambda state: with_status(merge_entries(state), max_shots, max_errors), every)


def latest_epoch(spark: SparkSession, out: str) -> DataFrame:
    """The newest result that was published to its end; only its folder is read."""
    finished = finished_epochs(spark, out)
    if not finished:
        raise FileNotFoundError(f"no finished epoch below {out}")
    return spark.read.parquet(f"{out}/epoch={finished[-1]}")


# ---- cumulative snapshots ---------------------------------------------------

RANK = ["is_final", "seq"]
COUNTERS = ["n", "shots", "errors", "discards", "seconds"]


SNAPSHOT_KEYS = ["batch_id", *RANK, "strong_id", "counter", "decoder", "json_metadata"]


def snapshot_entries(rows: DataFrame, key: Callable[[Column], Column] = snapshot_key) -> DataFrame:
    """Counters of the rows of new snapshot files per batch, snapshot, experiment and named counter."""
    keyed = counts_as_map(rows).select("*", key(F.col("file_path")).alias("_k")).select("*", "_k.*")
    return partial_entries(keyed, extra=("batch_id", *RANK)).select(*SNAPSHOT_KEYS, *COUNTERS)


def newest_snapshots(entries: DataFrame) -> DataFrame:
    """The entries of the newest snapshot of each batch, added up.

    Rows of one snapshot add up, also when it came in several files or holds an id
    more than once; a newer snapshot replaces the older one as a whole.
    """
    sums = entries.groupBy(*SNAPSHOT_KEYS).agg(*[F.sum(c).alias(c) for c in COUNTERS])
    ranked = sums.withColumn("_rank", F.struct(*RANK))
    newest = ranked.groupBy("batch_id").agg(F.max("_rank").alias("_rank"))
    return ranked.join(newest, ["batch_id", "_rank"], "left_semi").select(*SNAPSHOT_KEYS, *COUNTERS)


def start_snapshots(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    key: Callable[[Column], Column] = snapshot_key,
    every: str | None = None,
    kept: int = KEPT_EPOCHS,
) -> StreamingQuery:
    """Follow snapshot files: `state/` holds the newest counters per batch, `totals/` their sum.

    Epoch n is built from the new files and the state of epoch n - 1, so a
    replayed epoch gives the same result. Each epoch writes the state anew, which is
    as large as the newest snapshots together; the last few epochs are kept, at least two.
    """

    def publish(frame: DataFrame, epoch: int) -> None:
        spark = frame.sparkSession
        known = spark.read.parquet(f"{out}/state/epoch={epoch - 1}") if epoch > 0 else None
        path = f"{out}/state/epoch={epoch}"
        new = snapshot_entries(frame, key)
        newest_snapshots(new if known is None else new.unionByName(known)).write.mode("overwrite").parquet(path)
        merge_entries(spark.read.parquet(path)).write.mode("overwrite").parquet(f"{out}/totals/epoch={epoch}")
        for part in ("state", "totals"):
            drop_old_epochs(spark, f"{out}/{part}", max(2, kept))

    claim(rows.sparkSession, out, checkpoint)
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(publish)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
