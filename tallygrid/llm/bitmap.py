"""A bitmap of hashes with a fixed size: what it rejects is surely absent, what it passes is checked exactly later."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def build(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """2**bits bits, two set for each hash: its lowest and its highest bits. At most 2**(bits - 5) rows reach the driver."""
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    high = F.shiftrightunsigned(column, 64 - bits)
    places = hashes.select(F.explode(F.array(low, high)).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(31)).cast("int"))
    table = places.groupBy(F.shiftright("at", 5).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 5), np.uint32)
    if table.num_rows:
        out[table.column("word").to_numpy()] = table.column("bits").to_numpy().astype(np.uint32)
    return out


def has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether both bits of each unsigned hash are set."""
    n_bits = 32 * len(bitmap)
    out = _bit(bitmap, hashes & np.uint64(n_bits - 1))
    left = np.flatnonzero(out)
    out[left] = _bit(bitmap, hashes[left] >> np.uint64(65 - n_bits.bit_length()))
    return out


def _bit(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0


def bits_for(n: int, least: int = 16, most: int = 27) -> int:
    """Bits for n hashes at 16 places each, within bounds; beyond `most` more hashes pass falsely and nothing else changes."""
    return int(min(most, max(least, int(16 * max(n, 1) - 1).bit_length())))
