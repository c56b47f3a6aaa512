"""Explicit schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the counter files that users already have.
STATS_COLUMNS = ["shots", "errors", "discards", "seconds", "decoder", "strong_id", "json_metadata", "custom_counts"]
STATS_FILE = "stats.csv"

CORRUPT = "_corrupt"

STATS = T.StructType(
    [
        T.StructField("shots", T.LongType()),
        T.StructField("errors", T.LongType()),
        T.StructField("discards", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("decoder", T.StringType()),
        T.StructField("strong_id", T.StringType()),
        T.StructField("json_metadata", T.StringType()),
        T.StructField("custom_counts", T.StringType()),
    ]
)

STATS_RAW = T.StructType(STATS.fields + [T.StructField(CORRUPT, T.StringType())])

TIMINGS = T.StructType(
    [
        T.StructField("K", T.IntegerType()),
        T.StructField("p", T.DoubleType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)

TASKS = T.StructType(
    [
        T.StructField("task_id", T.StringType()),
        T.StructField("decoder", T.StringType()),
        T.StructField("num_det", T.IntegerType()),
        T.StructField("num_obs", T.IntegerType()),
        T.StructField("postselection_mask", T.ArrayType(T.BooleanType())),
        T.StructField("postselected_obs_mask", T.ArrayType(T.BooleanType())),
        T.StructField("max_shots", T.LongType()),
        T.StructField("max_errors", T.LongType()),
    ]
)

SHOTS = T.StructType(
    [
        T.StructField("task_id", T.StringType()),
        T.StructField("shot_id", T.LongType()),
        T.StructField("det", T.ArrayType(T.BooleanType())),
        T.StructField("obs", T.ArrayType(T.BooleanType())),
        T.StructField("pred", T.ArrayType(T.BooleanType())),
        T.StructField("pred_discard", T.BooleanType()),
    ]
)
