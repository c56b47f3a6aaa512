"""Counter fragments: CSV files below a root, local or in an object store."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrid.schema import CORRUPT, STATS_FILE, STATS_RAW

# Up to this many chosen files are read by path; more are found by a semi join.
MAX_EXPLICIT_PATHS = 10_000

JSON_COLUMNS = ("json_metadata", "custom_counts")

# Files of the standard layout; other CSV files below a root are not counters unless asked for.
LAYOUT_FILES = "{stats.csv,stats.partial*.csv}"


def plain_path(path: Column) -> Column:
    """A path as it is stored: the file metadata holds it percent-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def glob_escaped(path: str) -> str:
    """A path as the reader takes it literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def qualified(spark: SparkSession, path: str) -> tuple[str, str]:
    """(store, path) of a location: scheme and authority, and the path without them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}", uri.getPath().rstrip("/")


def is_below(path: Column, store: str, folder: str) -> Column:
    """Whether a file path lies in a folder of the same store, by whole path parts."""
    bare = F.regexp_extract(path, r"^(?:[^:/]+:(?://[^/]*)?)?(/.*)$", 1)
    home = F.regexp_replace(F.regexp_extract(path, r"^([^:/]+:(?://[^/]*)?)?/", 1), r"^([^:/]+:)$", "$1//")
    return home.isin("", store) & F.startswith(bare, F.lit(folder + "/"))


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Paths below `root`, recursively. The file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(entries(spark, root))
        .select(plain_path(F.col("_metadata.file_path")).alias("path"))
    )


def entries(spark: SparkSession, root: str) -> list[str]:
    """The folders to list for a root: a directory of mount points is told as links, which Spark's listing does not follow."""
    if not root.startswith("viewfs:"):
        return [root]
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    children = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return [c.getPath().toString() for c in children] if any(c.isSymlink() for c in children) else [root]


def _csv(spark: SparkSession, schema: T.StructType, header: bool):
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def read_raw(
    spark: SparkSession,
    paths: str | list[str],
    pattern: str = "*.csv",
    schema: T.StructType = STATS_RAW,
    header: bool = True,
) -> DataFrame:
    """All rows of the matching files, malformed ones included, with their file path."""
    return (
        _csv(spark, schema, header)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .csv(paths)
        .select("*", plain_path(F.col("_metadata.file_path")).alias("file_path"))
    )


def valid_json(text: Column | str) -> Column:
    """Whether a text is one whole JSON value of any kind: object, list, number, text or null.

    The parser ignores what follows a value, so the text is parsed inside a list and
    inside an object: anything left over breaks one of them.
    """
    one = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    inside = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))
    return F.coalesce((F.size(one) == 1) & inside.isNotNull(), F.lit(False))


def is_counter_map(text: Column | str) -> Column:
    """Whether a text is a JSON object of whole numbers, or holds no counters: NULL, or JSON null."""
    parsed = F.try_parse_json(text)
    counts = F.try_variant_get(parsed, "$", "map<string,variant>")
    whole = F.forall(F.map_values(counts), lambda v: F.schema_of_variant(v) == "BIGINT")
    return F.coalesce(whole, (F.col(text) if isinstance(text, str) else text).isNull() | F.is_variant_null(parsed))


def is_good(columns: list[str]) -> Column:
    """A complete row with readable numbers, whose JSON columns parse and whose counters are whole numbers.

    The reader does not mark a row cut inside its last quoted field, so the JSON
    has to be looked at as well; JSON of any kind will do. Files from before named
    counters end with the metadata; the reader marks their rows as short, and they
    are good when that field is whole.
    """
    good = F.col(CORRUPT).isNull()
    for name in JSON_COLUMNS:
        if name in columns:
            good = good & (F.col(name).isNull() | valid_json(name))
    without_counts = F.col("custom_counts").isNull() & valid_json("json_metadata")
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("shots", "errors", "discards", "seconds", "strong_id") if c in columns])
    return F.coalesce(complete & is_counter_map("custom_counts") & (good | without_counts), F.lit(False))


def good_rows(raw: DataFrame) -> DataFrame:
    return raw.filter(is_good(raw.columns)).drop(CORRUPT)


def quarantine(raw: DataFrame) -> DataFrame:
    """The rows that `good_rows` leaves out, with the file they came from."""
    return raw.filter(~is_good(raw.columns))


def read_fragments(spark: SparkSession, root: str, mode: str = "stats") -> DataFrame:
    """Good rows of all fragments below `root`; modes as in `read_fragments_raw`."""
    return good_rows(read_fragments_raw(spark, root, mode))


def read_fragments_raw(spark: SparkSession, root: str, mode: str = "stats") -> DataFrame:
    """All rows of all fragments below `root`, malformed ones included.

    `mode="stats"` reads files named exactly stats.csv, `"any"` every CSV file,
    `"auto"` every CSV file only if there is no stats.csv anywhere.
    """
    if mode not in ("stats", "any", "auto"):
        raise ValueError(f"mode is 'stats', 'any' or 'auto', not {mode!r}")
    pattern = "*.csv" if mode == "any" else STATS_FILE
    found = not list_files(spark, root, pattern).isEmpty()
    if not found and mode == "auto":
        pattern = "*.csv"
        found = not list_files(spark, root, pattern).isEmpty()
    if not found:
        raise FileNotFoundError(f"no {pattern} below {root}")
    return read_raw(spark, root, pattern)


def snapshot_key(path: Column) -> Column:
    """`(batch_id, is_final, seq)` of a path in the standard layout.

    `<run>/batch_<id>/stats.csv` is final; `<run>/batch_<id>/stats.partial.<seq>.csv`
    is a cumulative snapshot (without a number: sequence 0). The batch is its whole
    folder, so equal batch ids of two runs stay apart; a file outside such a folder
    is a batch of its own.
    """
    in_layout = path.rlike(r"(^|/)batch_[^/]+/[^/]+$")
    return F.struct(
        F.when(in_layout, F.regexp_extract(path, r"^(.*)/[^/]+$", 1)).otherwise(path).alias("batch_id"),
        F.element_at(F.split(path, "/"), -1).eqNullSafe(F.lit(STATS_FILE)).alias("is_final"),
        F.coalesce(F.regexp_extract(path, r"\.partial\.(\d+)\.csv$", 1).try_cast("bigint"), F.lit(0)).alias("seq"),
    )


def partition_snapshot_key(path: Column) -> Column:
    """The same for directories `<run>/batch_id=<id>/is_final=<bool>/seq=<n>/`."""
    return F.struct(
        F.regexp_extract(path, r"^(.*/batch_id=[^/]+)/", 1).alias("batch_id"),
        (F.regexp_extract(path, r"/is_final=([^/]+)/", 1) == "true").alias("is_final"),
        F.regexp_extract(path, r"/seq=(\d+)/", 1).try_cast("bigint").alias("seq"),
    )


def latest_files(files: DataFrame, key=snapshot_key) -> DataFrame:
    """Files of the newest snapshot of each batch; a final one supersedes all partial ones."""
    keyed = files.select("path", key(F.col("path")).alias("k"))
    newest = keyed.groupBy("k.batch_id").agg(F.max(F.struct("k.is_final", "k.seq")).alias("top"))
    return (
        keyed.select("path", "k.batch_id", F.struct("k.is_final", "k.seq").alias("top"))
        .join(newest, ["batch_id", "top"], "left_semi")
        .select("batch_id", "path")
    )


def read_latest_raw(spark: SparkSession, root: str, key=snapshot_key, pattern: str | None = None) -> DataFrame:
    """All rows, malformed ones included, of the newest snapshot of each batch.

    The file list alone decides which snapshots count. Up to MAX_EXPLICIT_PATHS
    chosen paths go to the reader; a longer choice is applied as a semi join, which
    gives the same rows but has to open the superseded files too. `pattern` names
    the files; without one, only those of the standard layout are taken.
    """
    pattern = pattern or (LAYOUT_FILES if key is snapshot_key else "*.csv")
    return read_chosen(spark, root, latest_files(list_files(spark, root, pattern), key).select("path"), pattern)


def read_chosen(spark: SparkSession, root: str, chosen: DataFrame, pattern: str, reader=read_raw) -> DataFrame:
    """The rows of some files below `root`: by path up to MAX_EXPLICIT_PATHS of them, else by a semi join."""
    paths = [row.path for row in chosen.limit(MAX_EXPLICIT_PATHS + 1).collect()]
    if not paths:
        raise FileNotFoundError(f"no {pattern} below {root}")
    if len(paths) <= MAX_EXPLICIT_PATHS:
        return reader(spark, [glob_escaped(p) for p in paths], pattern)
    return reader(spark, entries(spark, root), pattern).join(chosen.withColumnRenamed("path", "file_path"), "file_path", "left_semi")


def read_latest(spark: SparkSession, root: str, key=snapshot_key, pattern: str | None = None) -> DataFrame:
    """Good rows of the newest snapshot of each batch; see `read_latest_raw`."""
    return good_rows(read_latest_raw(spark, root, key, pattern))


def duplicate_files(raw: DataFrame, unit: Column | None = None) -> DataFrame:
    """Files with the same content, which a sum would count twice.

    `unit` names what counts as one file, such as the folder of a written batch.

    The fingerprint of a file is its row count with the sum and the XOR of its row
    hashes: it is built by partial aggregates, and no file has to fit in one row.
    Equal rows are legal data and are not touched.
    """
    columns = [c for c in raw.columns if c not in (CORRUPT, "file_path")]
    row_hash = F.xxhash64(*columns)
    files = raw.groupBy((F.col("file_path") if unit is None else unit).alias("file_path")).agg(
        F.count("*").alias("n_rows"),
        F.sum(row_hash.cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor(row_hash).alias("hash_xor"),
    )
    copies = files.groupBy("n_rows", "hash_sum", "hash_xor").agg(
        F.count("*").alias("n_files"), F.min("file_path").alias("first_file"), F.max("file_path").alias("last_file")
    )
    return copies.filter("n_files > 1").drop("hash_sum", "hash_xor")
