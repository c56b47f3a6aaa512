"""Rates and deviations. An undefined rate is NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def error_rate(errors: Column, shots: Column) -> Column:
    return F.try_divide(errors, shots)


def surviving(shots: Column, discards: Column) -> Column:
    return shots - discards


def postselected_error_rate(errors: Column, shots: Column, discards: Column) -> Column:
    """Errors per surviving shot, NULL without survivors."""
    return F.try_divide(errors, surviving(shots, discards))


def postselection_rate(shots: Column, discards: Column) -> Column:
    """Surviving share, 0 without shots."""
    return F.coalesce(F.try_divide(surviving(shots, discards), shots), F.lit(0.0))


def bernoulli_std(rate: Column, n: Column) -> Column:
    """Standard error of a rate measured on n trials."""
    return F.sqrt(F.try_divide(rate * (1 - rate), n))


def relative_deviation(a: Column, b: Column) -> Column:
    """(a - b) / a, and 0 when a is not positive."""
    return F.when(a > 0, (a - b) / a).otherwise(F.lit(0.0))


def percent_text(fraction: Column) -> Column:
    """Signed percentage for reports: 0.0125 as +1.25%."""
    return F.format_string("%+.2f%%", fraction * 100)


def rate_report(rate: Column, digits: int = 4) -> Column:
    """A rate with fixed decimals for reports."""
    return F.format_string(f"%.{digits}f", rate)
