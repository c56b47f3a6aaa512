"""Comparison of runs, backends, seeds, reference settings and noise channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.functions import rates, zscores as Z
from tallygrid.functions.bits import popcount, xor_bits


# ---- runs -------------------------------------------------------------------


def reconcile(a: DataFrame, b: DataFrame, key: str = "strong_id") -> DataFrame:
    """Full outer match of two combined runs, with the side each id was found on."""
    values = ("shots", "errors", "discards")
    left = a.select(key, *[F.col(c).alias("a_" + c) for c in values])
    right = b.select(key, *[F.col(c).alias("b_" + c) for c in values])
    status = (
        F.when(F.col("b_shots").isNull(), F.lit("left_only"))
        .when(F.col("a_shots").isNull(), F.lit("right_only"))
        .otherwise(F.lit("both"))
    )
    return left.join(right, key, "full").withColumn("status", status)


def reconcile_split(rows: DataFrame, run: str, a, b, key: str = "strong_id") -> DataFrame:
    """`reconcile` for two runs in one table: one scan and one shuffle, no join."""
    values = ("shots", "errors", "discards")

    def of(side, c):
        return F.sum(F.when(F.col(run) == side, F.col(c)))

    wide = rows.filter(F.col(run).isin(a, b)).groupBy(key).agg(
        *[of(a, c).alias("a_" + c) for c in values], *[of(b, c).alias("b_" + c) for c in values]
    )
    status = (
        F.when(F.col("b_shots").isNull(), F.lit("left_only"))
        .when(F.col("a_shots").isNull(), F.lit("right_only"))
        .otherwise(F.lit("both"))
    )
    return wide.withColumn("status", status)


def id_difference(a: DataFrame, b: DataFrame, key: str = "strong_id") -> DataFrame:
    """Ids found in one run only; empty when the two id sets are equal. One shuffle for both directions."""
    sides = a.select(key, F.lit(True).alias("_a")).unionByName(b.select(key, F.lit(False).alias("_a")))
    seen = sides.groupBy(key).agg(F.bool_or("_a").alias("in_a"), F.bool_and("_a").alias("only_a"))
    return seen.filter("only_a or not in_a").select(key, F.when(F.col("in_a"), "a").otherwise("b").alias("side"))


def rate_ratios(reconciled: DataFrame, min_errors: int = Z.MIN_ERRORS) -> DataFrame:
    """Error-rate ratio (>= 1) of the cells with enough errors in both runs."""
    rate_a = F.col("a_errors") / F.col("a_shots")
    rate_b = F.col("b_errors") / F.col("b_shots")
    return reconciled.filter(F.least("a_errors", "b_errors") >= min_errors).filter("status = 'both'").withColumn(
        "ratio", F.greatest(rate_a / rate_b, rate_b / rate_a)
    )


def reconcile_summary(reconciled: DataFrame, min_errors: int = Z.MIN_ERRORS) -> DataFrame:
    """Matched and unmatched ids, cells compared, and the worst ratio, in one row."""
    rate_a = F.col("a_errors") / F.col("a_shots")
    rate_b = F.col("b_errors") / F.col("b_shots")
    enough = (F.col("status") == "both") & (F.least("a_errors", "b_errors") >= min_errors)
    ratio = F.when(enough, F.greatest(rate_a / rate_b, rate_b / rate_a))
    return reconciled.agg(
        F.count_if(F.col("status") == "both").alias("matched"),
        F.count_if(F.col("status") == "left_only").alias("left_only"),
        F.count_if(F.col("status") == "right_only").alias("right_only"),
        F.count(ratio).alias("compared"),
        F.max(ratio).alias("worst_ratio"),
    )


# ---- backends ---------------------------------------------------------------


def backend_counts(shots: DataFrame, keys: list[str], backend: str, fired: Column, a, b) -> DataFrame:
    """Shots and events of two backends per cell, from one table in one aggregate."""
    is_a, is_b = F.col(backend) == a, F.col(backend) == b
    return shots.groupBy(*keys).agg(
        F.count_if(is_a).alias("n_a"),
        F.count_if(is_b).alias("n_b"),
        F.count_if(is_a & fired).alias("a"),
        F.count_if(is_b & fired).alias("b"),
    )


def join_backends(counts_a: DataFrame, counts_b: DataFrame, keys: list[str]) -> DataFrame:
    """The same cells from two tables of counts `(keys, shots, events)`."""
    left = counts_a.select(*keys, F.col("shots").alias("n_a"), F.col("events").alias("a"))
    right = counts_b.select(*keys, F.col("shots").alias("n_b"), F.col("events").alias("b"))
    return left.join(right, keys)


def detector_deviation(cells: DataFrame) -> DataFrame:
    """Per-cell rates and `z_max_p`; both backends sampled `n_a` shots."""
    rated = cells.withColumn("rate_a", F.try_divide("a", "n_a")).withColumn("rate_b", F.try_divide("b", "n_b"))
    return rated.withColumn("z", Z.z_max_p(F.col("rate_a"), F.col("rate_b"), F.col("n_a")))


def worst_detectors(deviations: DataFrame, order: list[str], limit: int = 10, sigma: float = Z.SIGMA_CONFIRMED) -> DataFrame:
    """Report of the first `limit` cells beyond `sigma`, in key order."""
    return deviations.filter(F.col("z") > sigma).orderBy(*order).limit(limit)


def total_deviation(totals: DataFrame) -> DataFrame:
    """The three forms on totals `a`, `b` over the same `trials`, and the deviation."""
    a, b, n = F.col("a"), F.col("b"), F.col("trials")
    return totals.select(
        "*",
        Z.z_first_p(a, b, n).alias("z_first"),
        Z.z_totals(a, b, n, "first").alias("z_rate_first"),
        Z.z_totals(a, b, n, "pooled").alias("z_pooled"),
        rates.relative_deviation(a, b).alias("rel_dev"),
    )


def rate_deviation(cells: DataFrame) -> DataFrame:
    """Signed unpooled z on rates of `n_a` and `n_b` shots."""
    rated = cells.withColumn("rate_a", F.try_divide("a", "n_a")).withColumn("rate_b", F.try_divide("b", "n_b"))
    return rated.select(
        "*",
        Z.z_unpooled(F.col("rate_a"), F.col("n_a"), F.col("rate_b"), F.col("n_b")).alias("z"),
        rates.relative_deviation(F.col("rate_a"), F.col("rate_b")).alias("rel_dev"),
    )


def worst_case(deviations: DataFrame) -> DataFrame:
    """Largest |z| and |deviation| over all cells, and the verdict on them."""
    worst = deviations.agg(F.max(F.abs("z")).alias("worst_z"), F.max(F.abs("rel_dev")).alias("worst_rel"))
    return worst.withColumn("verdict", Z.agreement_verdict(F.col("worst_z"), F.col("worst_rel")))


def case_summary(cases: DataFrame) -> DataFrame:
    """Mean |deviation| of detectors and observables over cases, and the usability verdict.

    Cases without reference flips do not count for the observables.
    """
    det = F.abs(rates.relative_deviation(F.col("a_det"), F.col("b_det")))
    obs = F.abs(rates.relative_deviation(F.col("a_obs"), F.col("b_obs")))
    summary = cases.agg(
        F.avg(det).alias("mean_det_dev"),
        F.avg(F.when(F.col("a_obs") > 0, obs)).alias("mean_obs_dev"),
    )
    return summary.withColumn("verdict", Z.usability_verdict(F.col("mean_obs_dev")))


# ---- seeds and trials -------------------------------------------------------


def seed_summary(trials: DataFrame) -> DataFrame:
    """Bias or noise? Mean and population deviation of the per-seed z."""
    scored = total_deviation(trials)
    summary = scored.agg(
        F.count("*").alias("seeds"),
        F.avg("z_pooled").alias("mean_z"),
        F.stddev_pop("z_pooled").alias("std_z"),
        F.avg("rel_dev").alias("mean_rel_dev"),
    )
    return summary.withColumn("verdict", Z.bias_verdict(F.col("mean_z")))


def variance_excess(trials: DataFrame, keys: list[str]) -> DataFrame:
    """Spread of trial rates against the spread that counting alone explains.

    `trials` has one row per trial with `events` and `trials`. The spread is the
    sample deviation (n - 1), the expected one is of the mean rate on the mean trial size.
    """
    rated = trials.withColumn("rate", F.try_divide("events", "trials"))
    spread = rated.groupBy(*keys).agg(
        F.count("*").alias("n_trials"),
        F.stddev_samp("rate").alias("trial_std"),
        F.avg("rate").alias("mean_rate"),
        F.avg("trials").alias("mean_trials"),
    )
    expected = rates.bernoulli_std(F.col("mean_rate"), F.col("mean_trials"))
    return spread.withColumn("expected_std", expected).withColumn("excess", F.try_divide("trial_std", "expected_std"))


# ---- reference settings and noise channels ----------------------------------


def flag_matrix(shots: DataFrame, reference_det: str, reference_obs: str) -> DataFrame:
    """Event totals under the four reference settings, from one pass over the shots."""
    totals = shots.agg(
        F.sum(popcount(F.col("det"))).alias("det_raw"),
        F.sum(popcount(xor_bits(F.col("det"), F.col(reference_det)))).alias("det_ref"),
        F.sum(popcount(F.col("obs"))).alias("obs_raw"),
        F.sum(popcount(xor_bits(F.col("obs"), F.col(reference_obs)))).alias("obs_ref"),
    )
    setting = F.array(
        *[
            F.struct(
                F.lit(use_det).alias("use_ref_det"),
                F.lit(use_obs).alias("use_ref_obs"),
                F.col("det_ref" if use_det else "det_raw").alias("det_total"),
                F.col("obs_ref" if use_obs else "obs_raw").alias("obs_total"),
            )
            for use_det in (False, True)
            for use_obs in (False, True)
        ]
    )
    return totals.select(F.inline(setting))


def flag_report(matrix: DataFrame) -> DataFrame:
    """The matrix with one column per observable setting."""
    return matrix.groupBy("use_ref_det").pivot("use_ref_obs", [False, True]).agg(
        F.first("det_total").alias("det"), F.first("obs_total").alias("obs")
    )


def channel_isolation(cells: DataFrame, baseline: str, channel: str = "channel") -> DataFrame:
    """Two backends per noise channel: deviation, exact agreement, events over the baseline channel."""
    totals = cells.groupBy(channel).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("trials").alias("trials"))
    channels = Window.partitionBy()  # one row per channel
    off = F.col(channel) == baseline
    return total_deviation(totals).select(
        "*",
        F.col("a").eqNullSafe(F.col("b")).alias("exact"),
        *[(F.col(c) - F.max(F.when(off, F.col(c))).over(channels)).alias(f"{c}_over_baseline") for c in ("a", "b")],
        Z.confirmation_verdict(F.col("z_pooled")).alias("verdict"),
    )
