"""Validation rules as a table of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.rates import error_rate


def violations(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """One row per key and rule that does not hold. A rule that is NULL does not hold."""
    broken = F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    return df.select(*keys, F.explode(F.array_compact(broken)).alias("rule"))


def prediction_rules(num_obs: Column, num_det: Column) -> dict[str, Column]:
    """Shapes of one shot: bits as declared, predictions for every observable and at most one byte more."""
    padded = F.ceil(num_obs / 8) * 8
    return {
        "detector count": F.size("det") == num_det,
        "observable count": F.size("obs") == num_obs,
        "too few predictions": F.size("pred") >= num_obs,
        "too many predictions": F.size("pred") <= padded + 8,
    }


def stats_rules(budget: Column | int) -> dict[str, Column]:
    """Ranges of one counter record."""
    shots, errors, discards = F.col("shots"), F.col("errors"), F.col("discards")
    return {
        "no shots": shots > 0,
        "negative counter": (errors >= 0) & (discards >= 0) & (F.col("seconds") >= 0),
        "errors and discards above shots": errors + discards <= shots,
        "rate outside 0 to 1": error_rate(errors, shots).between(0, 1),
        "shots above budget": shots <= budget,
    }
