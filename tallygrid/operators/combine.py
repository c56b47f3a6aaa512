"""Counter algebra: fragments add up by experiment id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.functions import rates


def union_fragments(frames: list[DataFrame], aggregate: bool = True) -> DataFrame:
    """All rows of all fragments; with `aggregate=False` a plain concatenation."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return combine(rows) if aggregate else rows


SUMS = ("shots", "errors", "discards", "seconds")


def partial_totals(stats: DataFrame, key: str = "strong_id") -> DataFrame:
    """Counters per id and per (decoder, metadata) it was seen with.

    The texts are grouping keys here and not aggregates: Spark then keeps to hash
    aggregation, where a minimum over strings would make it sort all rows.
    """
    kept = [c for c in ("decoder", "json_metadata") if c in stats.columns]
    return stats.groupBy(key, *kept).agg(*[F.sum(c).alias(c) for c in SUMS])


def merge_totals(partial: DataFrame, key: str = "strong_id") -> DataFrame:
    """One row per id from `partial_totals`; decoder and metadata are those of one fragment, the smallest pair."""
    kept = [c for c in ("decoder", "json_metadata") if c in partial.columns]
    sums = partial.groupBy(key).agg(*[F.sum(c).alias(c) for c in SUMS], *([F.min(F.struct(*kept)).alias("_pair")] if kept else []))
    return sums.select(key, *SUMS, *[F.col(f"_pair.{c}").alias(c) for c in kept])


def combine(stats: DataFrame, key: str = "strong_id") -> DataFrame:
    """One row per experiment: counters summed, decoder and metadata kept.

    Sums are built before each shuffle, so a hot id costs one row per task, and
    the second step sees about one row per experiment.
    """
    return merge_totals(partial_totals(stats, key), key)


def with_rates(totals: DataFrame) -> DataFrame:
    shots, errors, discards = F.col("shots"), F.col("errors"), F.col("discards")
    return totals.select(
        "*",
        rates.error_rate(errors, shots).alias("error_rate"),
        rates.surviving(shots, discards).alias("surviving"),
        rates.postselected_error_rate(errors, shots, discards).alias("err_rate"),
        rates.postselection_rate(shots, discards).alias("ps_rate"),
    )


def counters(stats: DataFrame, key: str = "strong_id", counts: str = "custom_counts") -> DataFrame:
    """Named counters in long form `(key, counter, n)`, summed key by key."""
    return (
        stats.select(key, F.explode(counts).alias("counter", "value"))
        .groupBy(key, "counter")
        .agg(F.sum("value").alias("n"))
    )


def counters_to_map(long: DataFrame, key: str = "strong_id") -> DataFrame:
    """One map per experiment; its size is the number of different counter names."""
    entries = F.sort_array(F.collect_list(F.struct("counter", "n")))
    return long.groupBy(key).agg(F.map_from_entries(entries).alias("custom_counts"))


def combine_with_counters(stats: DataFrame, key: str = "strong_id") -> DataFrame:
    """`combine` with the summed counter map, from one pass over the fragments.

    A fragment becomes one entry with its totals and one per named counter; both
    kinds are summed by the same partial aggregates.
    """
    return merge_entries(partial_entries(stats, key), key)


def partial_entries(stats: DataFrame, key: str = "strong_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """Sums per id, counter name (NULL: the totals), decoder and metadata, and `extra` columns."""
    kept = [c for c in ("decoder", "json_metadata") if c in stats.columns]
    nothing = [F.lit(None).cast("bigint" if c != "seconds" else "double").alias(c) for c in SUMS]
    totals = F.struct(F.lit(None).cast("string").alias("counter"), F.lit(None).cast("bigint").alias("n"), *SUMS)
    named = F.transform(F.map_entries("custom_counts"), lambda e: F.struct(e["key"].alias("counter"), e["value"].alias("n"), *nothing))
    entries = F.concat(F.array(totals), F.coalesce(named, F.array()))
    sums = [F.sum(c).alias(c) for c in ("n", *SUMS)]
    return stats.select(*extra, key, *kept, F.inline(entries)).groupBy(*extra, key, "counter", *kept).agg(*sums)


def merge_entries(partial: DataFrame, key: str = "strong_id") -> DataFrame:
    """One row per id with its totals and counter map, from `partial_entries`."""
    kept = [c for c in ("decoder", "json_metadata") if c in partial.columns]
    sums = [F.sum(c).alias(c) for c in ("n", *SUMS)]
    texts = [F.min(F.struct(*kept)).alias("_pair")] if kept else []
    per_counter = partial.groupBy(key, "counter").agg(*sums, *texts)
    named_sums = F.collect_list(F.when(F.col("counter").isNotNull(), F.struct("counter", "n")))
    merged = per_counter.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        *([F.min("_pair").alias("_pair")] if kept else []),
        F.map_from_entries(F.sort_array(named_sums)).alias("custom_counts"),
    )
    return merged.select(key, *SUMS, *[F.col(f"_pair.{c}").alias(c) for c in kept], "custom_counts")


def counts_as_map(stats: DataFrame) -> DataFrame:
    """Fragments whose `custom_counts` is a map, whether it was JSON text, a map, or missing."""
    if "custom_counts" not in stats.columns:
        return stats.withColumn("custom_counts", F.lit(None).cast("map<string,bigint>"))
    if stats.schema["custom_counts"].dataType.typeName() == "string":
        return stats.withColumn("custom_counts", parse_counts())
    return stats


def parse_counts(text_column: str = "custom_counts"):
    """Counter JSON of a stats file as a map."""
    return F.from_json(text_column, "map<string,bigint>")


def event_rate(counter_map: str = "custom_counts"):
    """Detection events per checked detector, from the counters of one record."""
    return F.try_divide(
        F.element_at(counter_map, F.lit("detection_events")),
        F.element_at(counter_map, F.lit("detectors_checked")),
    )


def inconsistent_ids(stats: DataFrame, key: str = "strong_id") -> DataFrame:
    """Ids that carry more than one (decoder, metadata) pair."""
    variants = stats.groupBy(key, "decoder", "json_metadata").agg(F.count("*").alias("n"))
    return (
        variants.groupBy(key)
        .agg(F.count("*").alias("variants"), F.sum("n").alias("n_rows"))
        .filter("variants > 1")
    )


def grand_totals(stats: DataFrame, key: str = "strong_id") -> DataFrame:
    """One row over everything. The exact id count runs on the combined ids."""
    per_id = stats.groupBy(key).agg(
        F.count("*").alias("n"),
        *[F.sum(c).alias(c) for c in ("shots", "errors", "discards")],
    )
    return per_id.agg(
        F.count("*").alias("experiments"),
        F.sum("n").alias("fragment_rows"),
        *[F.sum(c).alias("total_" + c) for c in ("shots", "errors", "discards")],
        F.min("shots").alias("min_shots"),
        F.max("shots").alias("max_shots"),
    )


def rows_per_id(stats: DataFrame, key: str = "strong_id") -> DataFrame:
    return stats.groupBy(key).agg(F.count("*").alias("n_rows"))


# Sketches of 2^14 counters: a relative standard error of 0.8 percent.
SKETCH_BITS = 14


def distinct_sketches(stats: DataFrame, groups: list[str], key: str = "strong_id", bits: int = SKETCH_BITS) -> DataFrame:
    """One mergeable sketch of the ids of each group, such as a fragment file: at most a few times 2^bits bytes, whatever it counts."""
    return stats.groupBy(*groups).agg(F.hll_sketch_agg(key, bits).alias("sketch"))


def distinct_estimate(sketches: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """About how many different ids the united sketches have seen, without reading their rows; NULL without sketches."""
    return sketches.groupBy(*(groups or [])).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))
