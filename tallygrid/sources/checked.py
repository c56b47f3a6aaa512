"""Counter files line by line: every file's own header names the fields, and every row that is not taken has a reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.schema import STATS, STATS_COLUMNS
from tallygrid.session import broadcast_if_small
from tallygrid.sources.fragments import is_counter_map, plain_path, valid_json

# Files from before named counters have one column less.
LAYOUTS = (STATS_COLUMNS, STATS_COLUMNS[:-1])
CSV = {"escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "columnNameOfCorruptRecord": "_bad", "inputBufferSize": "65536"}


def read_lines(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """(file_path, line) of all lines that are not blank."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(paths)
    return lines.select(plain_path(F.col("_metadata.file_path")).alias("file_path"), F.col("value").alias("line")).filter(F.trim("line") != "")


def _names(line: str) -> Column:
    return F.transform(F.split(line, ","), lambda c: F.trim(c))


def _fields(line: Column | str, many: int) -> Column:
    """The fields of a line as an array of texts; NULL if there are more or fewer of them."""
    names = [f"c{k}" for k in range(many)]
    row = F.from_csv(line, ", ".join(f"{c} string" for c in names) + ", _bad string", CSV)
    return F.when(row["_bad"].isNull(), F.array(*[row[c] for c in names]))


def _count_problem(name: str, value: Column) -> Column:
    number = value.try_cast("bigint")
    kind = F.when(value.isNull(), "missing").when(number.isNull(), "not a whole number").when(number < 0, "negative")
    return F.when(kind.isNotNull(), F.struct(F.lit(name).alias("column"), kind.alias("reason")))


def _problem(name: str, *cases: tuple[Column, str]) -> Column:
    return reduce(lambda kind, case: kind.when(case[0], F.struct(F.lit(name).alias("column"), F.lit(case[1]).alias("reason"))), cases, F)


def read_checked(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """All rows of the matching files with typed columns, file_path, line, and `problem` (column, reason; NULL for a good row).

    A line with a field that reads `shots` is a header and names the fields
    of its file, with or without named counters and in any order. A file has one
    header; of several different ones the smallest counts, and rows of another layout
    are problems. The first problem of a row, in column order, is reported: `no header`,
    `unknown header`, `fields` (more or fewer of them), `missing`, `not a whole
    number`, `not a number`, `negative`, `not JSON`, `not a counter map`.
    """
    lines = read_lines(spark, paths, pattern)
    heads = F.array_contains(_names("line"), STATS_COLUMNS[0])
    headers = lines.filter(heads).groupBy("file_path").agg(F.min(_names("line")).alias("_header"))
    rows = lines.filter(~heads).join(broadcast_if_small(headers), "file_path", "left")
    known = reduce(lambda a, b: a | b, [F.array_sort("_header") == F.array(*[F.lit(c) for c in sorted(layout)]) for layout in LAYOUTS])
    rows = rows.withColumn("_known", F.coalesce(known, F.lit(False)))
    split = reduce(lambda out, layout: out.when(F.size("_header") == len(layout), _fields("line", len(layout))), LAYOUTS, F)
    # Exploded, so that the line is parsed once and not once for each use of a field.
    rows = rows.select("*", F.explode(F.array(F.when(F.col("_known"), split))).alias("_fields"))
    value = {c: F.get("_fields", F.array_position("_header", c).cast("int") - 1) for c in STATS_COLUMNS}
    rows = rows.select("file_path", "line", "_header", "_known", "_fields", *[v.alias(f"_{c}") for c, v in value.items()])
    seconds = F.col("_seconds").try_cast("double")
    unlike = F.isnan(seconds) | (F.abs(seconds) == float("inf"))
    problem = F.coalesce(
        _problem("", (F.col("_header").isNull(), "no header"), (~F.col("_known"), "unknown header"), (F.col("_fields").isNull(), "fields")),
        *[_count_problem(c, F.col(f"_{c}")) for c in ("shots", "errors", "discards")],
        _problem("seconds", (F.col("_seconds").isNull(), "missing"), (seconds.isNull() | unlike, "not a number"), (seconds < 0, "negative")),
        _problem("strong_id", (F.col("_strong_id").isNull(), "missing")),
        _problem("json_metadata", (F.col("_json_metadata").isNotNull() & ~valid_json("_json_metadata"), "not JSON")),
        _problem("custom_counts", (F.col("_custom_counts").isNotNull() & ~valid_json("_custom_counts"), "not JSON"), (~is_counter_map("_custom_counts"), "not a counter map")),
    )
    typed = [F.col(f"_{f.name}").try_cast(f.dataType).alias(f.name) for f in STATS.fields]
    return rows.select(*typed, "file_path", "line", problem.alias("problem"))


def good(checked: DataFrame) -> DataFrame:
    """The rows without a problem, as `fragments.good_rows` gives them."""
    return checked.filter(F.col("problem").isNull()).drop("problem", "line")


def malformed(checked: DataFrame) -> DataFrame:
    """The rows with a problem: what could be read of them, file_path, column, reason and line."""
    return checked.filter(F.col("problem").isNotNull()).select(*STATS_COLUMNS, "file_path", "problem.column", "problem.reason", "line")
