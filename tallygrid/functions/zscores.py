"""The five sigma definitions of the sweep comparisons, and the verdicts built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygrid.functions.rates import bernoulli_std

# Thresholds the published verdicts depend on.
SIGMA_CONFIRMED = 5.0
SIGMA_LIKELY = 3.0
MEAN_SIGMA_SYSTEMATIC = 1.5
USABLE_DEVIATION = 0.05
MECHANICAL_DEVIATION = 0.08
PROBABILITY_FLOOR = 1e-6
MIN_ERRORS = 50
PS_RATE_RANGE = (0.05, 0.35)
ERR_RATE_LIMIT = 0.30


def _ratio_or_zero(difference: Column, sigma: Column) -> Column:
    return F.when(sigma > 0, difference / sigma).otherwise(F.lit(0.0))


def z_max_p(rate_a: Column, rate_b: Column, n: Column) -> Column:
    """Unsigned, sigma of the larger rate (floored) on n trials."""
    p = F.greatest(rate_a, rate_b, F.lit(PROBABILITY_FLOOR))
    return _ratio_or_zero(F.abs(rate_a - rate_b), F.sqrt(p * (1 - p) / n))


def z_totals(a: Column, b: Column, trials: Column, p_from: str = "pooled") -> Column:
    """Signed, on two totals over the same number of trials.

    `p_from="pooled"` estimates p from both totals, `"first"` from `a` alone. The
    form on two rates is the same number, since both sides divide by `trials`.
    """
    if p_from == "pooled":
        p = F.try_divide(a + b, 2 * trials)
    elif p_from == "first":
        p = F.try_divide(a, trials)
    else:
        raise ValueError(f"p_from is 'pooled' or 'first', not {p_from!r}")
    return _ratio_or_zero(a - b, F.sqrt(2 * trials * p * (1 - p)))


def z_first_p(a: Column, b: Column, trials: Column) -> Column:
    """Unsigned `z_totals` with p taken from the first total."""
    return F.abs(z_totals(a, b, trials, "first"))


def z_unpooled(rate_a: Column, n_a: Column, rate_b: Column, n_b: Column) -> Column:
    """Signed, each rate with its own standard error."""
    variance = F.pow(bernoulli_std(rate_a, n_a), 2) + F.pow(bernoulli_std(rate_b, n_b), 2)
    return _ratio_or_zero(rate_a - rate_b, F.sqrt(variance))


def bias_verdict(mean_z: Column, threshold: float = MEAN_SIGMA_SYSTEMATIC) -> Column:
    """Is the mean over seeds a bias, and in which direction?"""
    return (
        F.when(mean_z > threshold, F.lit("systematic: a above b"))
        .when(mean_z < -threshold, F.lit("systematic: a below b"))
        .otherwise(F.lit("statistical"))
    )


def usability_verdict(mean_abs_deviation: Column, limit: float = USABLE_DEVIATION) -> Column:
    return (
        F.when(mean_abs_deviation < limit, F.lit("usable"))
        .when(mean_abs_deviation.isNotNull(), F.lit("not usable"))
        .otherwise(F.lit("no flips"))
    )


def agreement_verdict(worst_z: Column, worst_deviation: Column) -> Column:
    """Three steps: agreement, mechanical agreement only, unusable."""
    return (
        F.when(worst_z < SIGMA_LIKELY, F.lit("agree"))
        .when(worst_deviation < MECHANICAL_DEVIATION, F.lit("mechanical only"))
        .otherwise(F.lit("unusable"))
    )


def confirmation_verdict(z: Column) -> Column:
    return (
        F.when(F.abs(z) > SIGMA_CONFIRMED, F.lit("confirmed"))
        .when(F.abs(z) > SIGMA_LIKELY, F.lit("likely"))
        .otherwise(F.lit("none"))
    )
