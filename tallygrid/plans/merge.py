"""Merge and report: fragments to totals with rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.operators import combine as C
from tallygrid.operators.curves import sweep_curve
from tallygrid.functions.names import parse_json_metadata
from tallygrid.sources import checked as K, fragments as S
from tallygrid.session import materialize
from tallygrid.sinks.stats import counts_as_json, write_stats


def merge(rows: DataFrame, with_counters: bool = False) -> DataFrame:
    """One row per experiment with rates, and its counter map when asked for."""
    if not with_counters:
        return C.with_rates(C.combine(rows))
    return C.with_rates(C.combine_with_counters(rows.withColumn("custom_counts", C.parse_counts())))


def input_files(spark: SparkSession, root: str, out: str | None = None, latest: bool = True) -> tuple[DataFrame, str]:
    """(paths to merge, the pattern they were found by); files below `out` are results and never merged again.

    Files of the standard layout come first; without any, every CSV file is one.
    """
    store, folder = S.qualified(spark, out) if out is not None else (None, None)
    if out is not None and (S.qualified(spark, root)[1] + "/").startswith(folder + "/") and S.qualified(spark, root)[0] == store:
        raise ValueError(f"the results {out} would lie at or above the inputs {root}")
    for pattern in (S.LAYOUT_FILES if latest else S.STATS_FILE, "*.csv"):
        files = S.list_files(spark, root, pattern)
        if out is not None:
            files = files.filter(~S.is_below(F.col("path"), store, folder))
        if not files.isEmpty():
            return (S.latest_files(files).select("path") if latest else files), pattern
    raise FileNotFoundError(f"no CSV file below {root}")


def merge_with_quarantine(spark: SparkSession, root: str, out: str | None = None, fmt: str = "csv", latest: bool = True) -> tuple[DataFrame, DataFrame]:
    """`merge_folder`, and beside the totals the rows that were not good: file_path, column, reason, line."""
    checked = S.read_chosen(spark, root, *input_files(spark, root, out, latest), reader=K.read_checked)
    merged = merge(K.good(checked), with_counters=True)
    if out is not None:
        merged = materialize(merged, "merged")  # written below and returned
        write_stats(counts_as_json(merged), out, fmt)
    return merged, K.malformed(checked)


def merge_folder(spark: SparkSession, root: str, out: str | None = None, fmt: str = "csv", latest: bool = True) -> DataFrame:
    """Merge the fragments below `root`, and write them when `out` is given.

    With `latest` each batch counts with its newest snapshot; without it every
    stats.csv is summed. Either way every CSV file is read when no file has the
    name of the standard layout. `merge_with_quarantine` also returns the rows that
    were not good, with the reason.
    """
    return merge_with_quarantine(spark, root, out, fmt, latest)[0]


def curves(rows: DataFrame, group: str = "concat(meta['type'], ' d=', meta['d'])", x: str = "cast(meta['p'] as double)") -> DataFrame:
    """Curve points of counters whose metadata is JSON; group and x are SQL expressions on `meta`."""
    return sweep_curve(rows.withColumn("meta", parse_json_metadata("json_metadata")), group, x)
