"""Running totals as a log: every epoch writes only what its new files add.

`deltas/epoch=<n>` holds the entries of epoch n and `base/epoch=<b>` all entries up to
epoch b, folded. Readers take the newest finished base and the finished deltas behind
it. A base is written when the deltas behind the last one have grown as large as it
is, so that all bases together stay within a small factor of what came in. A replayed
epoch overwrites its own folders and changes nothing else. The last two bases stay,
and the deltas behind the older one, for readers that are still at them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallygrid.operators.combine import SUMS, counts_as_map, merge_entries, partial_entries
from tallygrid.sources.fragments import good_rows, is_good, snapshot_key
from tallygrid.streaming.collect import claim, finished_epochs, newest_snapshots, snapshot_entries, _folder

# Deltas below this size are never a reason to write a base.
LEAST_BYTES = 64 << 20


def _bytes(spark: SparkSession, paths: list[str]) -> int:
    out = 0
    for path in paths:
        fs, where = _folder(spark, path)
        out += fs.getContentSummary(where).getLength()
    return out


def _parts(spark: SparkSession, out: str, before: int | None = None) -> tuple[str | None, list[str]]:
    """The newest base (below an epoch, if given) and the deltas behind it."""
    bases = [n for n in finished_epochs(spark, f"{out}/base") if before is None or n < before]
    last = bases[-1] if bases else -1
    deltas = [n for n in finished_epochs(spark, f"{out}/deltas") if n > last]
    return (f"{out}/base/epoch={last}" if bases else None), [f"{out}/deltas/epoch={n}" for n in deltas]


def read_entries(spark: SparkSession, out: str, before: int | None = None) -> DataFrame:
    """All entries so far: of the newest base and of the deltas behind it."""
    base, deltas = _parts(spark, out, before)
    if base is None and not deltas:
        raise FileNotFoundError(f"no finished epoch below {out}")
    return reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in ([base] if base else []) + deltas])


def _fold_base(spark: SparkSession, out: str, epoch: int, fold: Callable[[DataFrame], DataFrame], least_bytes: int) -> None:
    base, deltas = _parts(spark, out, before=epoch)
    if _bytes(spark, deltas) < max(least_bytes, _bytes(spark, [base]) if base else 0):
        return
    fold(read_entries(spark, out, before=epoch)).write.mode("overwrite").parquet(f"{out}/base/epoch={epoch}")
    bases = finished_epochs(spark, f"{out}/base")
    old = [f"{out}/base/epoch={n}" for n in bases[:-2]]
    if len(bases) > 1:
        old += [f"{out}/deltas/epoch={n}" for n in finished_epochs(spark, f"{out}/deltas") if n <= bases[-2]]
    for path in old:
        fs, where = _folder(spark, path)
        fs.delete(where, True)


def start_deltas(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    entries: Callable[[DataFrame], DataFrame],
    fold: Callable[[DataFrame], DataFrame],
    every: str | None = None,
    least_bytes: int = LEAST_BYTES,
) -> StreamingQuery:
    """Write the `entries` of each batch of good rows as a delta, with the batch's own figures in `metrics/`.

    `raw` may hold malformed rows (with their marks) or good ones alone. `every="60
    seconds"` keeps running at that pace; without it the query drains what is there
    and stops. Files, good rows and quarantined rows are observed while the delta is
    written, not counted in a second pass, but for a batch without any good row.
    """

    def publish(frame: DataFrame, epoch: int) -> None:
        spark, seen = frame.sparkSession, Observation()
        marked = "_corrupt" in frame.columns
        ok = is_good(frame.columns) if marked else F.lit(True)
        files = F.size(F.collect_set("file_path")) if "file_path" in frame.columns else F.lit(None).cast("int")  # bounded by the files of a trigger
        figures = [F.count_if(ok).alias("good"), F.count_if(~ok).alias("quarantined"), F.max(F.lit(0)).alias("zero"), *([files.alias("files")] if "file_path" in frame.columns else [])]
        watched, delta = frame.observe(seen, *figures), f"{out}/deltas/epoch={epoch}"
        entries(good_rows(watched) if marked else watched).write.mode("overwrite").parquet(delta)
        # Where no row is good, adaptive execution replaces the plan by an empty one that observes nothing.
        got = frame.agg(*figures).first().asDict() if spark.read.parquet(delta).isEmpty() else seen.get
        row = [(epoch, got["good"], got["quarantined"], got.get("files"))]
        spark.createDataFrame(row, "epoch long, good long, quarantined long, files int").coalesce(1).write.mode("overwrite").parquet(f"{out}/metrics/epoch={epoch}")
        _fold_base(spark, out, epoch, fold, least_bytes)

    claim(raw.sparkSession, out, checkpoint)
    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(publish)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _sum_entries(seen: DataFrame) -> DataFrame:
    sums = ("n", *SUMS)
    return seen.groupBy(*[c for c in seen.columns if c not in sums]).agg(*[F.sum(c).alias(c) for c in sums])


def follow_totals(raw: DataFrame, out: str, checkpoint: str, every: str | None = None, least_bytes: int = LEAST_BYTES) -> StreamingQuery:
    """Counters per experiment and named counter, one delta per epoch; `read_totals` adds them up."""
    return start_deltas(raw, out, checkpoint, lambda rows: partial_entries(counts_as_map(rows)), _sum_entries, every, least_bytes)


def read_totals(spark: SparkSession, out: str) -> DataFrame:
    """One row per experiment with its totals and counter map, as of the last finished epoch."""
    return merge_entries(_sum_entries(read_entries(spark, out)))


def follow_snapshots(
    raw: DataFrame, out: str, checkpoint: str, key: Callable[[Column], Column] = snapshot_key, every: str | None = None, least_bytes: int = LEAST_BYTES
) -> StreamingQuery:
    """Snapshot files as deltas: which snapshot of a batch is the newest is decided when they are read or folded.

    A base drops what is superseded by then. A later part of a snapshot adds to the
    earlier part, in whichever epoch it comes.
    """
    return start_deltas(raw, out, checkpoint, lambda rows: snapshot_entries(rows, key), newest_snapshots, every, least_bytes)


def read_snapshot_totals(spark: SparkSession, out: str) -> DataFrame:
    """One row per experiment over the newest snapshots of all batches."""
    return merge_entries(newest_snapshots(read_entries(spark, out)))


def read_metrics(spark: SparkSession, out: str) -> DataFrame:
    """(epoch, good, quarantined, files) of every finished epoch."""
    epochs = [f"{out}/metrics/epoch={n}" for n in finished_epochs(spark, f"{out}/metrics")]
    return spark.read.schema("epoch long, good long, quarantined long, files int").parquet(*epochs)


def job_progress(spark: SparkSession, jobs: dict[str, str], read: Callable[[SparkSession, str], DataFrame] = read_totals) -> DataFrame:
    """One row per job (name to folder): epochs, files, good and quarantined rows, and the totals its counters have reached."""

    def one(job: str, out: str) -> DataFrame:
        seen = read_metrics(spark, out).agg(F.count("*").alias("epochs"), *[F.sum(c).cast("long").alias(c) for c in ("files", "good", "quarantined")])
        totals = read(spark, out).agg(F.count("*").alias("experiments"), *[F.sum(c).alias(c) for c in ("shots", "errors")])
        return seen.select(F.lit(job).alias("job"), "*").join(totals.select(F.lit(job).alias("job"), "*"), "job")

    return reduce(DataFrame.unionByName, [one(job, out) for job, out in jobs.items()])
