"""Parameter grids, and the instruction text of the K-round sequences."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.functions import layout as L
from tallygrid.functions.names import rate_text
from tallygrid.operators.ordered import join_groups
from tallygrid.session import materialize

# The instructions of one round on its five data bits {0}..{4}.
ROUND_TEMPLATE = """\
R {0} {1} {2} {3} {4}
R_X({theta}) {0} {1} {2} {3} {4}
T_DAG {0} {1} {2} {3} {4}
DEPOLARIZE1({p}) {0} {1} {2} {3} {4}
SQRT_X {0} {1} {4}
CZ {0} {1} {2} {3}
SQRT_Y {0} {3}
CZ {0} {2} {3} {4}
TICK
SQRT_X_DAG {0}
CZ {0} {4} {1} {3}
TICK
SQRT_X_DAG {0} {1} {2} {3} {4}
T {0}
R_X({minus_theta}) {0}
M {0} {1} {2} {3} {4}"""

# Expected check bits of a successful round.
SUCCESS_CHECKS = (1, 0, 1, 1)

# Parameter values of the two standard sweeps.
DISTANCES = (3, 5, 7, 9, 11, 13)
MEMORY_RATES = (0.0005, 0.001, 0.002, 0.003, 0.005, 0.008, 0.01)
ROUNDS = (1, 2, 3, 4, 5)
SEQUENCE_RATES = (0.001, 0.003, 0.01, 0.03, 0.05)


def parameter_grid(spark: SparkSession, **axes: list) -> DataFrame:
    """Every combination of the given axis values, one column per axis."""
    grid = spark.range(1).drop("id")
    for name, values in axes.items():
        grid = grid.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return grid


def grid_coverage(stats: DataFrame, row_axis: str, column_axis: str) -> DataFrame:
    """Every cell of the grid spanned by the observed axis values, with its shots (0 where none ran).

    A NULL axis value is a value like any other. The axes are the parameters of a
    sweep: the grid is their product by definition.
    """
    cells = materialize(stats.groupBy(row_axis, column_axis).agg(F.sum("shots").alias("shots"), F.count("*").alias("n_rows")), "cells")
    rows = cells.select(row_axis).distinct()
    columns = cells.select(F.struct(column_axis).alias("v")).distinct().agg(F.collect_list("v").alias("_columns"))
    grid = rows.select(row_axis, F.lit(1).alias("_one")).join(F.broadcast(columns.withColumn("_one", F.lit(1))), "_one")
    grid = grid.select(row_axis, F.explode("_columns").alias("_v")).select(row_axis, F.col(f"_v.{column_axis}").alias(column_axis))
    return join_groups(grid, cells, [row_axis, column_axis], "left").na.fill(0, ["shots", "n_rows"])


def sequence_layout(k: Column) -> Column:
    """Sizes of a sequence of k rounds."""
    return F.struct(
        L.data_bits(k).alias("data_bits"),
        L.check_bits(k).alias("check_bits"),
        L.total_measurements(k).alias("measurements"),
        L.check_bits(k).alias("detectors"),
        k.alias("observables"),
        L.t_count(k).alias("t_count"),
    )


def record_offsets(rounds: DataFrame, k: str = "K") -> DataFrame:
    """Record offsets of all data and check bits, one row per bit."""
    per_round = rounds.select("*", F.explode(F.sequence(F.lit(0), F.col(k) - 1)).alias("round"))
    bits = F.concat(
        *[F.array(F.struct(F.lit("data").alias("kind"), F.lit(i).alias("bit"), L.data_offset(F.col(k), F.col("round"), i).alias("rec_offset"))) for i in range(L.DATA_PER_ROUND)],
        *[F.array(F.struct(F.lit("check").alias("kind"), F.lit(j).alias("bit"), L.check_offset(F.col(k), F.col("round"), j).alias("rec_offset"))) for j in range(L.CHECKS_PER_ROUND)],
    )
    return per_round.select("*", F.inline(bits))


def _round_text(bits: Column) -> Column:
    """The template with the five bit numbers filled in; `{p}` is left for the caller."""
    constants = {"theta": repr(L.THETA), "minus_theta": repr(-L.THETA), "p": "{p}"}
    pieces = []
    for text, field in re.findall(r"([^{]*)(?:\{(\w+)\})?", ROUND_TEMPLATE):
        if text:
            pieces.append(F.lit(text))
        if field:
            pieces.append(F.lit(constants[field]) if field in constants else F.get(bits, int(field)))
    return F.concat(*pieces)


def sequence_text(k: Column, p: Column) -> Column:
    """Instruction text of k rounds at rate p, NULL for k < 1. Built in the row, without a join."""
    rounds = F.sequence(F.lit(0), k - 1)
    first_check = L.data_bits(k)
    checks = F.sequence(first_check, L.total_measurements(k) - 1)

    def words(numbers: Column) -> Column:
        return F.array_join(F.transform(numbers, lambda n: n.cast("string")), " ")

    def record(offset: Column) -> Column:
        return F.concat(F.lit("rec["), offset.cast("string"), F.lit("]"))

    numbered = F.transform(rounds, lambda r: F.array(*[(r * L.DATA_PER_ROUND + i).cast("string") for i in range(L.DATA_PER_ROUND)]))
    gates = F.replace(F.array_join(F.transform(numbered, _round_text), "\n"), F.lit("{p}"), rate_text(p))
    flipped = F.flatten(
        F.transform(
            rounds,
            lambda r: F.array(*[first_check + r * L.CHECKS_PER_ROUND + j for j, bit in enumerate(SUCCESS_CHECKS) if bit]),
        )
    )
    preparation = F.array(
        F.concat(F.lit("R "), words(checks)), F.concat(F.lit("X "), words(flipped)), F.concat(F.lit("M "), words(checks))
    )
    detectors = F.flatten(
        F.transform(
            rounds,
            lambda r: F.array(
                *[
                    F.concat(F.lit("DETECTOR "), record(L.data_offset(k, r, j + 1)), F.lit(" "), record(L.check_offset(k, r, j)))
                    for j in range(L.CHECKS_PER_ROUND)
                ]
            ),
        )
    )
    observables = F.transform(
        rounds,
        lambda r: F.concat(F.lit("OBSERVABLE_INCLUDE("), r.cast("string"), F.lit(") "), record(L.data_offset(k, r, 0))),
    )
    return F.when(k >= 1, F.array_join(F.concat(F.array(gates), preparation, detectors, observables), "\n"))


def sequence_name(k: Column, p: Column, family: str, extension: str = "circuit") -> Column:
    """File name of a generated sequence: `family_K=3_p=0.01.extension`."""
    return F.concat(F.lit(family + "_K="), k.cast("string"), F.lit("_p="), rate_text(p), F.lit("." + extension))


def memory_name(d: Column, p: Column, basis: Column, kind: Column, extension: str) -> Column:
    """File name of a memory experiment: `d=3,p=0.01,b=X,type=name.extension`."""
    return F.concat(
        F.lit("d="), d.cast("string"), F.lit(",p="), rate_text(p), F.lit(",b="), basis, F.lit(",type="), kind, F.lit("." + extension)
    )
