"""Index arithmetic of the K-round sequences: five data and four check bits per round."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sizes of one round.
DATA_PER_ROUND = 5
CHECKS_PER_ROUND = 4
T_PER_ROUND = 12

# Fixed value: the rotation angle of the sequences in units of pi.
THETA = -0.3040867239846964


def theta() -> Column:
    """The rotation angle from its definition: minus the arc cosine of the root of one third, over pi."""
    return -F.acos(F.sqrt(F.lit(1.0) / 3)) / F.pi()


def data_bits(k: Column) -> Column:
    return k * DATA_PER_ROUND


def check_bits(k: Column) -> Column:
    return k * CHECKS_PER_ROUND


def total_measurements(k: Column) -> Column:
    return k * (DATA_PER_ROUND + CHECKS_PER_ROUND)


def t_count(k: Column) -> Column:
    return k * T_PER_ROUND


def data_offset(rounds: Column, k: Column, i: Column | int) -> Column:
    """Record offset, from the end, of data bit i in round k."""
    return k * DATA_PER_ROUND + i - total_measurements(rounds)


def check_offset(rounds: Column, k: Column, j: Column | int) -> Column:
    """Record offset, from the end, of check bit j in round k."""
    return data_bits(rounds) + k * CHECKS_PER_ROUND + j - total_measurements(rounds)
