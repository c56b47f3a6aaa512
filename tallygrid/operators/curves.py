"""Sweep curves: rate against a parameter, one series per label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions import rates, zscores as Z


def sweep_curve(stats: DataFrame, series: str, x: str) -> DataFrame:
    """Points `(series, x)` with summed counters and rates. Both arguments are SQL expressions."""
    points = stats.groupBy(F.expr(series).alias("series"), F.expr(x).alias("x")).agg(
        *[F.sum(c).alias(c) for c in ("shots", "errors", "discards")]
    )
    shots, errors, discards = F.col("shots"), F.col("errors"), F.col("discards")
    rate = rates.error_rate(errors, shots)
    return points.select(
        "*",
        rate.alias("error_rate"),
        rates.bernoulli_std(rate, shots).alias("std_error"),
        rates.postselected_error_rate(errors, shots, discards).alias("err_rate"),
        rates.postselection_rate(shots, discards).alias("ps_rate"),
    )


def curve_table(curve: DataFrame, series: list[str], value: str = "error_rate") -> DataFrame:
    """One row per x, one column per series. The series are named, so no extra pass finds them."""
    return curve.groupBy("x").pivot("series", series).agg(F.first(value))


def end_points(curve: DataFrame, value: str = "err_rate") -> DataFrame:
    """Rates at the smallest and largest x of each series."""
    return curve.groupBy("series").agg(F.min_by(value, "x").alias("first_rate"), F.max_by(value, "x").alias("last_rate"))


def sanity(curve: DataFrame) -> DataFrame:
    """Failed checks per series: `warning` does not fail a sweep, `error` does.

    Published ranges: post-selection rate 5-35 %, error rate below 30 %, and the
    rate at the largest x above the one at the smallest.
    """
    low, high = Z.PS_RATE_RANGE
    checks = curve.groupBy("series").agg(
        F.count_if((F.col("ps_rate") < low) | (F.col("ps_rate") > high)).alias("ps_out"),
        # An undefined rate passes no check.
        F.count_if(F.coalesce(F.col("err_rate") >= Z.ERR_RATE_LIMIT, F.lit(True))).alias("err_out"),
        F.min_by("err_rate", "x").alias("first_rate"),
        F.max_by("err_rate", "x").alias("last_rate"),
    )
    rising = F.coalesce(F.col("first_rate") < F.col("last_rate"), F.lit(False))

    def row(rule: str, severity: str, n: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), n.cast("bigint").alias("n_points"))

    report = F.array(
        row("ps_rate in range", "warning", F.col("ps_out")),
        row("err_rate below limit", "error", F.col("err_out")),
        row("err_rate rising", "error", F.when(rising, 0).otherwise(1)),
    )
    return checks.select("series", F.inline(report)).filter("n_points > 0")
