import pytest
from pyspark.sql import functions as F

from tallygrid.operators import checks, combine as C, compare, curves, ledger

SCHEMA = "strong_id string, shots long, errors long, discards long, seconds double, decoder string, json_metadata string"


@pytest.fixture(scope="module")
def stats(spark):
    rows = [(f"id{i % 5}", 10 + i, i % 4, i % 3, 0.5 * i, "m", "{}") for i in range(40)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


def test_combine_does_not_depend_on_grouping(stats):
    whole = C.combine(stats)
    parts = [stats.filter(F.col("shots") % 3 == i) for i in range(3)]
    by_parts = C.combine(C.union_fragments([C.combine(p) for p in reversed(parts)], aggregate=False))
    assert rows_of(whole) == rows_of(by_parts)
    assert rows_of(C.combine(whole)) == rows_of(whole)


def test_concatenation_keeps_every_row(stats):
    assert C.union_fragments([stats, stats], aggregate=False).count() == 80
    assert C.union_fragments([stats, stats]).agg(F.sum("shots")).first()[0] == 2 * stats.agg(F.sum("shots")).first()[0]


def test_counts_beyond_32_bits(spark):
    df = spark.createDataFrame([("a", 5_890_000_000, 344_000, 0, 1.0, "m", "{}")] * 2, SCHEMA)
    assert C.combine(df).first().shots == 11_780_000_000
    assert C.grand_totals(df).first().total_shots == 11_780_000_000


def test_rates_of_empty_experiments(spark):
    df = spark.createDataFrame([("none", 0, 0, 0, 0.0, "m", "{}"), ("lost", 4, 0, 4, 0.0, "m", "{}")], SCHEMA)
    got = {r.strong_id: (r.error_rate, r.err_rate, r.ps_rate) for r in C.with_rates(df).collect()}
    assert got == {"none": (None, None, 0.0), "lost": (0.0, None, 0.0)}


def test_counter_maps_add_key_by_key(spark):
    df = spark.createDataFrame([("a", {"x": 1, "y": 2}), ("a", {"y": 3}), ("b", {"z": 1}), ("c", {})], "strong_id string, custom_counts map<string,bigint>")
    got = {r.strong_id: r.custom_counts for r in C.counters_to_map(C.counters(df)).collect()}
    assert got == {"a": {"x": 1, "y": 5}, "b": {"z": 1}}


def test_totals_and_counters_in_one_pass(spark):
    rows = [("a", 1, 0, 0, 0.5, "m", "{}", {"x": 1, "y": 2}), ("a", 2, 1, 0, 0.5, "f", "{}", {"y": 3}), ("b", 4, 0, 1, 0.0, "m", "{}", None), ("c", 8, 0, 0, 0.0, "m", "{}", {})]
    df = spark.createDataFrame(rows, SCHEMA + ", custom_counts map<string,bigint>")
    got = C.combine_with_counters(df)
    assert {r.strong_id: r.custom_counts for r in got.collect()} == {"a": {"x": 1, "y": 5}, "b": {}, "c": {}}
    assert rows_of(got.drop("custom_counts")) == rows_of(C.combine(df))


def test_inconsistent_ids(spark):
    rows = [("a", "m", "1"), ("a", "m", "1"), ("b", "m", "1"), ("b", "f", "1"), ("c", "m", "1"), ("c", "m", "2"), ("c", "m", None)]
    df = spark.createDataFrame(rows, "strong_id string, decoder string, json_metadata string")
    assert rows_of(C.inconsistent_ids(df)) == [(2, "b", 2), (3, "c", 3)]


def test_reconcile_and_ratio(spark):
    def run(rows):
        return spark.createDataFrame([(i, s, e, 0) for i, s, e in rows], "strong_id string, shots long, errors long, discards long")

    a = run([("x", 1000, 60), ("y", 1000, 50), ("z", 10, 1), ("only_a", 5, 0)])
    b = run([("x", 1000, 50), ("y", 500, 49), ("z", 10, 1), ("only_b", 5, 0)])
    both = compare.reconcile(a, b)
    assert {r.strong_id: r.status for r in both.collect()} == {"x": "both", "y": "both", "z": "both", "only_a": "left_only", "only_b": "right_only"}
    summary = compare.reconcile_summary(both).first()
    assert (summary.matched, summary.left_only, summary.right_only, summary.compared) == (3, 1, 1, 1)
    assert summary.worst_ratio == pytest.approx(1.2)
    assert [r.strong_id for r in compare.rate_ratios(both).collect()] == ["x"]
    assert rows_of(compare.id_difference(a, b)) == [("a", "only_a"), ("b", "only_b")]
    assert compare.id_difference(a, a).count() == 0


def test_seeds_use_the_population_deviation(spark):
    trials = spark.createDataFrame([(60, 40, 100), (50, 50, 100), (0, 0, 100)], "a long, b long, trials long")
    got = compare.seed_summary(trials).first()
    z = 20 / 50**0.5
    assert got.mean_z == pytest.approx(z / 3)
    assert got.std_z == pytest.approx(((z * z) / 3 - (z / 3) ** 2) ** 0.5)
    assert got.mean_rel_dev == pytest.approx((20 / 60) / 3)


def test_variance_excess_uses_the_sample_deviation(spark):
    df = spark.createDataFrame([("t", 10, 100), ("t", 30, 100)], "k string, events long, trials long")
    got = compare.variance_excess(df, ["k"]).first()
    assert got.trial_std == pytest.approx(0.02**0.5)
    assert got.excess == pytest.approx(0.02**0.5 / 0.04)


def test_noiseless_backends_agree_exactly(spark):
    df = spark.createDataFrame([("off", 0, 0, 100), ("x", 9, 4, 100)], "channel string, a long, b long, trials long")
    got = {r.channel: r for r in compare.channel_isolation(df, "off").collect()}
    assert got["off"].exact and got["off"].z_pooled == 0 and got["off"].verdict == "none"
    assert (got["x"].a_over_baseline, got["x"].b_over_baseline, got["x"].exact) == (9, 4, False)


def test_cases_without_reference_flips_do_not_count(spark):
    df = spark.createDataFrame([(100, 90, 0, 7), (100, 100, 10, 9)], "a_det long, b_det long, a_obs long, b_obs long")
    got = compare.case_summary(df).first()
    assert got.mean_det_dev == pytest.approx(0.05) and got.mean_obs_dev == pytest.approx(0.1) and got.verdict == "not usable"


def test_curve_sanity(spark):
    rows = [("ok", 0.001, 100, 80, 2), ("ok", 0.01, 100, 85, 4), ("falling", 0.001, 100, 80, 4), ("falling", 0.01, 100, 50, 1), ("lost", 0.1, 10, 10, 0)]
    df = spark.createDataFrame(rows, "name string, p double, shots long, discards long, errors long")
    curve = curves.sweep_curve(df, "name", "p")
    got = {(r.series, r.rule, r.severity) for r in curves.sanity(curve).collect()}
    assert got == {
        ("falling", "ps_rate in range", "warning"), ("falling", "err_rate rising", "error"),
        ("lost", "ps_rate in range", "warning"), ("lost", "err_rate below limit", "error"), ("lost", "err_rate rising", "error"),
    }


def test_ledger(spark):
    jobs = spark.createDataFrame(
        [("base", 0, 0.0, 7200.0, 7200.0), ("seven", 0, 0.0, 3000.0, 2900.0), ("seven", 1, 10.0, 2000.0, 1900.0)],
        "run_id string, job_id long, start_s double, end_s double, seconds double",
    )
    got = {r.run_id: r for r in ledger.run_ledger(jobs, "base", 0.5).collect()}
    seven = got["seven"]
    assert seven.speed_up == pytest.approx(2.4) and seven.instances == 2 and seven.slowest_job == 0
    assert seven.cost == pytest.approx(4800 / 3600 * 0.5) and seven.imbalance == pytest.approx(2900 / 2400)
    assert seven.overhead_seconds == pytest.approx(100)
    assert got["base"].speed_up == 1


def test_violations_name_the_rule(spark):
    df = spark.createDataFrame([("good", 10, 1, 1, 0.1), ("many", 10, 9, 9, 0.1), ("empty", 0, 0, 0, 0.0)], "strong_id string, shots long, errors long, discards long, seconds double")
    got = {(r.strong_id, r.rule) for r in checks.violations(df, ["strong_id"], checks.stats_rules(100)).collect()}
    assert got == {("many", "errors and discards above shots"), ("empty", "no shots"), ("empty", "rate outside 0 to 1")}


def test_stored_sketches_unite_over_runs(spark):
    rows = spark.range(60_000).selectExpr("concat('f', id % 6) AS file", "cast(id % 20000 as string) AS strong_id")
    sketches = C.distinct_sketches(rows, ["file"])
    assert abs(C.distinct_estimate(sketches).first().about - 20_000) < 600
    halves = sketches.selectExpr("*", "file < 'f3' AS run")
    by_run = {r.run: r.about for r in C.distinct_estimate(halves, ["run"]).collect()}
    for run, test in ((True, "file < 'f3'"), (False, "file >= 'f3'")):
        exact = rows.filter(test).select("strong_id").distinct().count()
        assert abs(by_run[run] - exact) <= 0.03 * exact
    assert C.distinct_estimate(C.distinct_sketches(rows.limit(0), ["file"])).first().about in (None, 0)
