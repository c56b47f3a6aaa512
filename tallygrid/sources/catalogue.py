"""Experiment files and timing tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.functions import names
from tallygrid.operators.balance import latest_timings
from tallygrid.schema import TIMINGS
from tallygrid.sources.fragments import plain_path


def read_catalogue(spark: SparkSession, root: str, extension: str, recursive: bool = True) -> DataFrame:
    """`(path, name, stem, text)` of all files with the extension. An empty catalogue is an error.

    The full path identifies a file, so equal names in two folders are two experiments.
    """
    reader = spark.read.option("pathGlobFilter", "*." + extension.lstrip(".")).option("recursiveFileLookup", recursive)
    files = reader.text(root, wholetext=True).select(plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("text"))
    if files.isEmpty():
        raise FileNotFoundError(f"no .{extension.lstrip('.')} files below {root}")
    return files.select("path", names.basename(F.col("path")).alias("name"), names.stem(F.col("path")).alias("stem"), "text")


# Text that one packed file holds, about.
PACKED_BYTES = 256 << 20


def compact(spark: SparkSession, root: str, extension: str, out: str, max_bytes: int = PACKED_BYTES) -> int:
    """Pack the files of a catalogue that `out` does not hold yet into few Parquet files by path; returns how many were new.

    Later scans open those files instead of one per experiment, and a filter on `path`
    reads only what may hold it: the rows lie in path order, so that each file and
    row group covers a range. A packed text counts as it was read then; a changed file
    has to come under a new name. Runs jobs; rows are in files of about `max_bytes`.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*." + extension.lstrip(".")).option("recursiveFileLookup", True).load(root)
    listed = files.select(plain_path(F.col("_metadata.file_path")).alias("path"), "length")
    catalogue = read_catalogue(spark, root, extension)
    try:
        known = spark.read.parquet(f"{out}/texts").select("path")
    except AnalysisException:  # nothing packed yet
        known = None
    if known is not None:
        listed, catalogue = listed.join(known, "path", "left_anti"), catalogue.join(known, "path", "left_anti")
    many, size = listed.agg(F.count("*"), F.sum("length")).first()
    if not many:
        return 0
    parts = -(-(size or 1) // max_bytes)
    spread = catalogue.repartitionByRange(parts, "path") if parts > 1 else catalogue.repartition(1)
    spread.sortWithinPartitions("path").write.mode("append").parquet(f"{out}/texts")
    return many


def read_compacted(spark: SparkSession, out: str) -> DataFrame:
    """The packed catalogue, as `read_catalogue` gives it."""
    return spark.read.schema("path string, name string, stem string, text string").parquet(f"{out}/texts")


def compacted_index(spark: SparkSession, out: str) -> DataFrame:
    """(file, first_path, last_path, n_texts): which packed file holds a path."""
    rows = read_compacted(spark, out).select("path", F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("file").agg(F.min("path").alias("first_path"), F.max("path").alias("last_path"), F.count("*").alias("n_texts"))


def read_timings(spark: SparkSession, path: str) -> DataFrame:
    """`(K, p, seconds)`; the last row of a key wins, files in name order."""
    rows = (
        spark.read.schema(TIMINGS)
        .option("header", True)
        .csv(path)
        .select("*", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("_order"))
    )
    return latest_timings(rows, ["K", "p"], "_order")


def split_by_name(catalogue: DataFrame, parse, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(experiments whose names parse and hold the required fields, the others)."""
    parsed = catalogue.withColumn("meta", parse(F.col("path")))
    fields = F.array_intersect(F.map_keys("meta"), F.array(*[F.lit(f) for f in required]))
    good = F.coalesce(F.size(fields) == len(set(required)), F.lit(False))
    return parsed.filter(good), parsed.filter(~good).drop("meta")
