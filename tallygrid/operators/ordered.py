"""Global order at scale: row index, rank in a group, running totals.

A plain window needs every row of a group in one task. Groups too large for that
are range partitioned on the full sort key instead, which spreads them over many
slices, and only one number per slice (never a row) is needed to stitch the slices
together. The sorted slices are written once to the shared folder: every later
pass and every retry then sees the same slice ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.session import broadcast_if_small, materialize

# A key with more rows than this is not given to a single task.
HOT_ROWS = 5_000_000

SLICE = "_slice"
POSITION = "_position"


def _sorted_slices(df: DataFrame, order: list[Column | str], tag: str) -> DataFrame:
    """Range partition and sort by `order`; add the slice id and the position in the slice."""
    row = F.monotonically_increasing_id()  # partition number in the bits above 33, row number below
    slices = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", row)
        .withColumn(SLICE, F.shiftright("_row", 33).cast("int"))
        .withColumn(POSITION, F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_row")
    )
    return materialize(slices, tag)


def index_rows(df: DataFrame, order: list[Column | str], name: str = "row_index", tag: str = "index") -> DataFrame:
    """Add the 0-based position of each row in the global order. `order` has to be total."""
    slices = _sorted_slices(df, order, tag)
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, so the window and the broadcast are bounded by the number of partitions.
    starts = (
        slices.groupBy(SLICE)
        .count()
        .select(SLICE, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    return slices.join(F.broadcast(starts), SLICE).withColumn(name, F.col("_start") + F.col(POSITION)).drop(SLICE, POSITION, "_start")


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on group columns, where NULL is a group like any other."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


# Counters of the sketch that looks for hot keys.
BUCKETS = 1 << 16


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys with more than `hot_rows` rows, as a written table; None if there are none.

    A sketch of BUCKETS counters by key hash is summed first, folded in every task: a
    hot key makes its bucket hot, so without hot buckets nothing else is counted. The
    keys of hot buckets are then counted exactly.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    crowded = [r["_bucket"] for r in df.groupBy(bucket.alias("_bucket")).count().filter(F.col("count") > hot_rows).select("_bucket").collect()]
    if not crowded:
        return None
    inside = df.filter(bucket.isin(crowded)) if len(crowded) < BUCKETS // 2 else df
    hot = materialize(inside.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(*keys), "hot")
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(rows of keys that fit in one task, rows of the others or None).

    There are at most `rows / hot_rows` hot keys, so their table is safe to broadcast.
    Runs jobs, which read `df` without writing it: a costly `df` should be a written
    table.
    """
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return df, None
    side = F.broadcast(hot)
    return join_groups(df, side, keys, "left_anti"), join_groups(df, side, keys, "left_semi")


def rank_within(df: DataFrame, groups: list[str], order: list[Column | str], name: str = "rank", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the 0-based rank of each row in its group; a group may be of any size.

    A group that fits in one task is ranked by a window; the rows of the larger
    ones are ranked through the global order.
    """
    cold, hot = split_hot(df, groups, hot_rows)
    ranked = cold.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)).cast("bigint") - 1)
    if hot is None:
        return ranked
    indexed = index_rows(hot, groups + order, "_global", "rank")
    starts = indexed.groupBy(*groups).agg(F.min("_global").alias("_start"))
    spread = join_groups(indexed, broadcast_if_small(starts, derived=True), groups).withColumn(name, F.col("_global") - F.col("_start"))
    return ranked.unionByName(spread.drop("_global", "_start"))


def preceding_totals(
    df: DataFrame, key: str, order: list[Column | str], values: list[str], suffix: str = "_before", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add, for each value column, its sum over the earlier rows of the same key.

    A key that fits in one task is summed by a window; the larger ones are summed
    slice by slice.
    """
    cold, hot = split_hot(df, [key], hot_rows)
    earlier = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = cold.select("*", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(v + suffix) for v in values])
    if hot is None:
        return summed
    return summed.unionByName(_preceding_by_slice(hot, key, order, values, suffix))


def _preceding_by_slice(df: DataFrame, key: str, order: list[Column | str], values: list[str], suffix: str) -> DataFrame:
    slices = _sorted_slices(df, [key] + order, "running")
    earlier = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sums = slices.groupBy(key, SLICE).agg(*[F.sum(v).alias(v) for v in values])
    # A slice can go on with at most one key begun in an earlier slice, so the
    # carry table has at most one row per slice and is safe to broadcast.
    carry = (
        sums.select(key, SLICE, *[F.sum(v).over(earlier).alias(f"_carry_{v}") for v in values], F.count("*").over(earlier).alias("_n"))
        .filter("_n > 0")
        .drop("_n")
    )
    inside = Window.partitionBy(key, SLICE).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
    out = join_groups(slices, F.broadcast(carry), [key, SLICE], "left")
    for v in values:
        running = F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.coalesce(F.col(f"_carry_{v}"), F.lit(0))
        out = out.withColumn(v + suffix, running)
    return out.drop(SLICE, POSITION, *[f"_carry_{v}" for v in values])
