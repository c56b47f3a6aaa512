import random

import pytest
from pyspark.sql import functions as F

from tallygrid.operators import ordered as O, progress as P

pytestmark = pytest.mark.usefixtures("many_slices")


@pytest.fixture(scope="module")
def skewed(spark):
    """5,000 rows, of which a third has the key `hot`."""
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(200)}", i, rng.randrange(10), rng.randrange(3)) for i in range(5000)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, seq long, shots long, errors long").repartition(7)


def test_index_is_the_global_position(spark, skewed):
    got = {(r.key, r.seq): r.row_index for r in O.index_rows(frame(spark, skewed), ["key", "seq"]).collect()}
    want = {(k, s): i for i, (k, s, *_) in enumerate(sorted(skewed))}
    assert got == want


@pytest.mark.parametrize("hot_rows", [1, 100, 10_000])
def test_rank_counts_from_zero_in_each_group(spark, skewed, hot_rows):
    ranked = O.rank_within(frame(spark, skewed), ["key"], [F.col("seq").desc()], hot_rows=hot_rows)
    got = {(r.key, r.seq): r["rank"] for r in ranked.collect()}
    want, seen = {}, {}
    for key, seq, *_ in sorted(skewed, key=lambda r: -r[1]):
        want[key, seq] = seen.get(key, 0)
        seen[key] = seen.get(key, 0) + 1
    assert got == want


@pytest.mark.parametrize("hot_rows", [1, 100, 10_000])
def test_preceding_totals_cross_slices(spark, skewed, hot_rows):
    rows = O.preceding_totals(frame(spark, skewed), "key", ["seq"], ["shots", "errors"], hot_rows=hot_rows).collect()
    assert len(rows) == len(skewed)
    want, running = {}, {}
    for key, seq, shots, errors in sorted(skewed, key=lambda r: r[1]):
        s, e = running.get(key, (0, 0))
        want[key, seq] = (s, e)
        running[key] = (s + shots, e + errors)
    assert {(r.key, r.seq): (r.shots_before, r.errors_before) for r in rows} == want


def test_a_hot_key_is_spread_over_slices(spark, skewed):
    slices = O._sorted_slices(frame(spark, skewed), ["key", "seq"], "test")
    per_slice = slices.filter("key = 'hot'").groupBy("_slice").count().count()
    assert per_slice >= 2


def test_only_the_hot_key_is_split_off(spark, skewed):
    cold, hot = O.split_hot(frame(spark, skewed), ["key"], 100)
    assert {r.key for r in hot.select("key").distinct().collect()} == {"hot"}
    assert cold.count() + hot.count() == len(skewed)
    assert O.split_hot(frame(spark, skewed), ["key"], 10_000)[1] is None


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([(None, i, 1) for i in range(6)] + [("a", 1, 1)], "key string, seq long, shots long")
    for hot_rows in (3, 100):
        rows = O.preceding_totals(df, "key", ["seq"], ["shots"], hot_rows=hot_rows).filter("key is null").orderBy("seq").collect()
        assert [r.shots_before for r in rows] == list(range(6))


def test_stop_rule_keeps_the_overshooting_fragment(spark):
    rows = [("a", 1, 30, 1), ("a", 2, 30, 1), ("a", 3, 30, 1), ("b", 1, 5, 9), ("b", 2, 5, 0), ("c", 1, 1, 0)]
    df = spark.createDataFrame(rows, "strong_id string, seq long, shots long, errors long")
    kept = P.stop_rule(df, ["seq"], 50, 8)
    got = {r.strong_id: (r.fragments, r.shots, r.errors, r.end_reason) for r in P.stopped_totals(kept, 50, 8).collect()}
    assert got == {"a": (2, 60, 2, "max_shots"), "b": (1, 5, 9, "max_errors"), "c": (1, 1, 0, None)}


def test_remaining_and_unfinished(spark):
    tasks = spark.createDataFrame([("a", 100, 10), ("b", 100, 10), ("c", 100, 10)], "strong_id string, max_shots long, max_errors long")
    totals = spark.createDataFrame([("a", 40, 3), ("b", 20, 10)], "strong_id string, shots long, errors long")
    left = {r.strong_id: (r.remaining_shots, r.remaining_errors, r.end_reason) for r in P.remaining_work(tasks, totals).collect()}
    assert left == {"a": (60, 7, None), "b": (0, 0, "max_errors"), "c": (100, 10, None)}
    assert {r.strong_id for r in P.unfinished(tasks, totals).collect()} == {"a", "c"}
