"""Counter algebra, progress, reconciliation, curves and ledger on the event fragments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.operators import checks, combine as C, compare, curves, grid, ledger, ordered, progress
from tallygrid.session import materialize
from tallygrid.workload import query
from tallygrid.workload.views import (
    MAX_ERRORS, MAX_SHOTS, MIN_ERRORS, ROUNDS_SQL, TOTALS_SQL, day_counts, fragment_sql, fragments, rounds, table,
)

FRAG = fragment_sql()
RUN = ", CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS run"
RUNS = fragment_sql(RUN, "WHERE NOT (event_id % 2 = 1 AND user_id % 37 = 0)")
RECONCILED = RUNS + """,
    wide AS (
      SELECT strong_id,
             CAST(sum(shots) FILTER (WHERE run = 'a') AS BIGINT) AS a_shots,
             CAST(sum(errors) FILTER (WHERE run = 'a') AS BIGINT) AS a_errors,
             CAST(sum(discards) FILTER (WHERE run = 'a') AS BIGINT) AS a_discards,
             CAST(sum(shots) FILTER (WHERE run = 'b') AS BIGINT) AS b_shots,
             CAST(sum(errors) FILTER (WHERE run = 'b') AS BIGINT) AS b_errors,
             CAST(sum(discards) FILTER (WHERE run = 'b') AS BIGINT) AS b_discards
      FROM fragments GROUP BY strong_id),
    reconciled AS (
      SELECT *, CASE WHEN b_shots IS NULL THEN 'left_only' WHEN a_shots IS NULL THEN 'right_only' ELSE 'both' END AS status
      FROM wide)
"""


def event_fragments(spark, sf_dir, *extra):
    return fragments(table(spark, sf_dir, "events"), *extra)


def two_runs(spark, sf_dir):
    """Even events are run a, odd ones run b, which lacks some users."""
    events = table(spark, sf_dir, "events").withColumn("run", F.when(F.col("event_id") % 2 == 0, "a").otherwise("b"))
    return fragments(events.filter("not (event_id % 2 = 1 and user_id % 37 = 0)"), "run")


@query(FRAG + "," + TOTALS_SQL + """
    SELECT strong_id, shots, errors, discards, round(seconds, 4) AS seconds, decoder, json_metadata,
           round(errors / shots, 6) AS error_rate, shots - discards AS surviving,
           round(errors / nullif(shots - discards, 0), 6) AS err_rate,
           round((shots - discards) / shots, 6) AS ps_rate
    FROM totals""")
def combine_by_id(spark, sf_dir):
    """The flagship. Fragments to one row per experiment, with rates."""
    totals = C.with_rates(C.combine(event_fragments(spark, sf_dir)))
    return totals.select(
        "strong_id", "shots", "errors", "discards", F.round("seconds", 4).alias("seconds"), "decoder", "json_metadata",
        F.round("error_rate", 6).alias("error_rate"), "surviving",
        F.round("err_rate", 6).alias("err_rate"), F.round("ps_rate", 6).alias("ps_rate"),
    )


@query("""
    SELECT sha256('u' || CAST(user_id AS VARCHAR)) AS strong_id, event_type AS counter, CAST(count(*) AS BIGINT) AS n
    FROM events GROUP BY ALL""")
def combine_counter_map(spark, sf_dir):
    """A3: counter maps of all days summed key by key, in long form."""
    return C.counters(day_counts(table(spark, sf_dir, "events")))


@query("""
    WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
    SELECT sha256('u' || CAST(user_id AS VARCHAR)) AS strong_id,
           '{' || string_agg('"' || event_type || '":' || CAST(n AS VARCHAR), ',' ORDER BY event_type) || '}' AS counts
    FROM c GROUP BY user_id""")
def counter_map_json(spark, sf_dir):
    """A3: the summed map per experiment, as the JSON text of a counter file."""
    maps = C.counters_to_map(C.counters(day_counts(table(spark, sf_dir, "events"))))
    return maps.select("strong_id", F.to_json("custom_counts").alias("counts"))


@query(FRAG + """,
    mixed AS (
      SELECT strong_id, CASE WHEN user_id % 10 = 0 AND day(day) % 2 = 0 THEN 'other' ELSE decoder END AS decoder, json_metadata
      FROM fragments),
    variants AS (SELECT strong_id, decoder, json_metadata, count(*) AS n FROM mixed GROUP BY ALL)
    SELECT strong_id, CAST(count(*) AS BIGINT) AS variants, CAST(sum(n) AS BIGINT) AS n_rows
    FROM variants GROUP BY strong_id HAVING count(*) > 1""")
def id_consistency(spark, sf_dir):
    """A2: ids whose fragments name two decoders; every tenth user is given one on even days."""
    other = (F.col("user_id") % 10 == 0) & (F.dayofmonth("day") % 2 == 0)
    rows = event_fragments(spark, sf_dir)
    return C.inconsistent_ids(rows.withColumn("decoder", F.when(other, "other").otherwise(F.col("decoder"))))


@query(FRAG + """,
    per_id AS (SELECT strong_id, count(*) AS n, sum(shots) AS shots, sum(errors) AS errors, sum(discards) AS discards
               FROM fragments GROUP BY strong_id)
    SELECT CAST(count(*) AS BIGINT) AS experiments, CAST(sum(n) AS BIGINT) AS fragment_rows,
           CAST(sum(shots) AS BIGINT) AS total_shots, CAST(sum(errors) AS BIGINT) AS total_errors,
           CAST(sum(discards) AS BIGINT) AS total_discards,
           CAST(min(shots) AS BIGINT) AS min_shots, CAST(max(shots) AS BIGINT) AS max_shots
    FROM per_id""")
def grand_totals(spark, sf_dir):
    """Totals, exact number of experiments, smallest and largest."""
    return C.grand_totals(event_fragments(spark, sf_dir))


@query(FRAG + "SELECT strong_id, CAST(count(*) AS BIGINT) AS n_rows FROM fragments GROUP BY strong_id")
def rows_per_id(spark, sf_dir):
    """Fragment rows behind each id."""
    return C.rows_per_id(event_fragments(spark, sf_dir))


@query(fragment_sql(", CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS run") + """
    SELECT strong_id, CAST(day AS VARCHAR) AS day, shots, errors, discards FROM fragments""")
def union_concat(spark, sf_dir):
    """The fragments of two runs concatenated, equal ids kept apart."""
    events = table(spark, sf_dir, "events").withColumn("run", F.when(F.col("event_id") % 2 == 0, "a").otherwise("b"))
    rows = fragments(events, "run")
    both = C.union_fragments([rows.filter("run = 'a'"), rows.filter("run = 'b'")], aggregate=False)
    return both.select("strong_id", F.col("day").cast("string").alias("day"), "shots", "errors", "discards")


@query(FRAG + f""",
    running AS (
      SELECT *, coalesce(sum(shots) OVER w, 0) AS shots_before, coalesce(sum(errors) OVER w, 0) AS errors_before
      FROM fragments
      WINDOW w AS (PARTITION BY strong_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    kept AS (SELECT * FROM running WHERE shots_before < {MAX_SHOTS} AND errors_before < {MAX_ERRORS})
    SELECT strong_id, CAST(count(*) AS BIGINT) AS fragments, CAST(sum(shots) AS BIGINT) AS shots,
           CAST(sum(errors) AS BIGINT) AS errors,
           CASE WHEN sum(errors) >= {MAX_ERRORS} THEN 'max_errors' WHEN sum(shots) >= {MAX_SHOTS} THEN 'max_shots' END AS end_reason
    FROM kept GROUP BY strong_id""")
def stop_rule(spark, sf_dir):
    """Fragments counted up to the limits, and the limit that was met."""
    kept = progress.stop_rule(
        event_fragments(spark, sf_dir).select("strong_id", "day", "shots", "errors"), ["day"], MAX_SHOTS, MAX_ERRORS
    )
    return progress.stopped_totals(kept, MAX_SHOTS, MAX_ERRORS)


@query(FRAG + "," + TOTALS_SQL + """,
    ended AS (SELECT *, CASE WHEN errors >= 14 THEN 'max_errors' WHEN shots >= 65 THEN 'max_shots' END AS end_reason FROM totals)
    SELECT min(shots) AS min_shots, (SELECT end_reason FROM ended ORDER BY shots, strong_id LIMIT 1) AS min_reason,
           max(shots) AS max_shots, (SELECT end_reason FROM ended ORDER BY shots DESC, strong_id DESC LIMIT 1) AS max_reason
    FROM ended""")
def shot_extremes(spark, sf_dir):
    """Smallest and largest experiment and what ended them."""
    totals = C.combine(event_fragments(spark, sf_dir))
    return progress.shot_extremes(totals.withColumn("end_reason", progress.end_reason(F.col("shots"), F.col("errors"), 65, 14)))


@query(FRAG + "," + TOTALS_SQL + f""",
    ended AS (SELECT *, CASE WHEN errors >= 14 THEN 'max_errors' WHEN shots >= 65 THEN 'max_shots' ELSE 'open' END AS state FROM totals)
    SELECT state, CAST(count(*) AS BIGINT) AS experiments, CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(errors) AS BIGINT) AS errors
    FROM ended GROUP BY state""")
def progress_view(spark, sf_dir):
    """Open and ended experiments over everything collected."""
    totals = C.combine(event_fragments(spark, sf_dir))
    return progress.progress_summary(totals.withColumn("end_reason", progress.end_reason(F.col("shots"), F.col("errors"), 65, 14)))


@query(FRAG + """
    SELECT strong_id, CAST(day AS VARCHAR) AS day, CAST(row_number() OVER (PARTITION BY d, p ORDER BY strong_id, day) - 1 AS BIGINT) AS trial
    FROM fragments""")
def trial_index(spark, sf_dir):
    """Number of each repeated trial in its grid cell."""
    rows = event_fragments(spark, sf_dir).select("d", "p", "strong_id", "day")
    ranked = ordered.rank_within(rows, ["d", "p"], ["strong_id", "day"], "trial")
    return ranked.select("strong_id", F.col("day").cast("string").alias("day"), "trial")


TASKS = """,
    have AS (SELECT strong_id, CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(errors) AS BIGINT) AS errors
             FROM fragments WHERE day(day) <= 15 AND user_id % 11 <> 0 GROUP BY strong_id),
    tasks AS (SELECT DISTINCT strong_id, 30 + d AS max_shots, CAST(9 AS BIGINT) AS max_errors FROM fragments),
    state AS (
      SELECT tasks.*, coalesce(shots, 0) AS shots, coalesce(errors, 0) AS errors,
             coalesce(shots, 0) >= max_shots OR coalesce(errors, 0) >= max_errors AS done
      FROM tasks LEFT JOIN have USING (strong_id))
"""


def tasks_and_totals(spark, sf_dir):
    """Every user is a task; the first 15 days are already on disk, for most of them."""
    rows = event_fragments(spark, sf_dir)
    tasks = rows.select("strong_id", (30 + F.col("d")).alias("max_shots"), F.lit(9).cast("bigint").alias("max_errors")).distinct()
    return tasks, C.combine(rows.filter("dayofmonth(day) <= 15 and user_id % 11 <> 0"))


@query(FRAG + TASKS + """
    SELECT strong_id, max_shots, max_errors,
           CASE WHEN done THEN 0 ELSE max_shots - shots END AS remaining_shots,
           CASE WHEN done THEN 0 ELSE max_errors - errors END AS remaining_errors,
           CASE WHEN errors >= max_errors THEN 'max_errors' WHEN shots >= max_shots THEN 'max_shots' END AS end_reason
    FROM state""")
def resume_remaining(spark, sf_dir):
    """What each task still needs, given the counters on disk."""
    return progress.remaining_work(*tasks_and_totals(spark, sf_dir))


@query(FRAG + TASKS + "SELECT strong_id, max_shots, max_errors FROM state WHERE NOT done")
def unfinished_tasks(spark, sf_dir):
    """The tasks to run again."""
    return progress.unfinished(*tasks_and_totals(spark, sf_dir))


@query(RECONCILED + "SELECT * FROM reconciled")
def run_reconcile(spark, sf_dir):
    """Two runs matched by id, from one table in one aggregate."""
    return compare.reconcile_split(two_runs(spark, sf_dir), "run", "a", "b")


def joined_runs(spark, sf_dir):
    rows = two_runs(spark, sf_dir)
    return compare.reconcile(C.combine(rows.filter("run = 'a'")), C.combine(rows.filter("run = 'b'")))


@query(RECONCILED + "SELECT * FROM reconciled")
def run_reconcile_tables(spark, sf_dir):
    """The same for two runs stored apart, as a full outer join."""
    return joined_runs(spark, sf_dir)


@query(RECONCILED + f"""
    SELECT strong_id, a_errors, b_errors,
           round(greatest((a_errors / a_shots) / (b_errors / b_shots), (b_errors / b_shots) / (a_errors / a_shots)), 6) AS ratio
    FROM reconciled WHERE status = 'both' AND least(a_errors, b_errors) >= {MIN_ERRORS}""")
def run_ratios(spark, sf_dir):
    """Error-rate ratio of the cells with enough errors in both runs."""
    ratios = compare.rate_ratios(compare.reconcile_split(two_runs(spark, sf_dir), "run", "a", "b"), MIN_ERRORS)
    return ratios.select("strong_id", "a_errors", "b_errors", F.round("ratio", 6).alias("ratio"))


@query(RECONCILED + f"""
    SELECT CAST(count(*) FILTER (WHERE status = 'both') AS BIGINT) AS matched,
           CAST(count(*) FILTER (WHERE status = 'left_only') AS BIGINT) AS left_only,
           CAST(count(*) FILTER (WHERE status = 'right_only') AS BIGINT) AS right_only,
           CAST(count(*) FILTER (WHERE status = 'both' AND least(a_errors, b_errors) >= {MIN_ERRORS}) AS BIGINT) AS compared,
           round(max(greatest((a_errors / a_shots) / (b_errors / b_shots), (b_errors / b_shots) / (a_errors / a_shots)))
             FILTER (WHERE status = 'both' AND least(a_errors, b_errors) >= {MIN_ERRORS}), 6) AS worst_ratio
    FROM reconciled""")
def run_summary(spark, sf_dir):
    """Matched ids and the worst ratio in one row."""
    summary = compare.reconcile_summary(compare.reconcile_split(two_runs(spark, sf_dir), "run", "a", "b"), MIN_ERRORS)
    return summary.withColumn("worst_ratio", F.round("worst_ratio", 6))


@query("""
    WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_id % 2 = 0),
    b AS (SELECT DISTINCT user_id FROM events WHERE event_id % 2 = 1 AND user_id % 37 <> 0)
    SELECT sha256('u' || CAST(user_id AS VARCHAR)) AS strong_id, 'a' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL
    SELECT sha256('u' || CAST(user_id AS VARCHAR)) AS strong_id, 'b' AS side FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def run_id_difference(spark, sf_dir):
    """Ids that only one run holds."""
    rows = two_runs(spark, sf_dir)
    return compare.id_difference(C.combine(rows.filter("run = 'a'")), C.combine(rows.filter("run = 'b'")))


CURVE = FRAG + """,
    curve AS (
      SELECT kind || ' d=' || CAST(d AS VARCHAR) AS series, p AS x,
             CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(errors) AS BIGINT) AS errors, CAST(sum(discards) AS BIGINT) AS discards
      FROM fragments GROUP BY ALL),
    rated AS (
      SELECT *, errors / shots AS error_rate, errors / nullif(shots - discards, 0) AS err_rate,
             (shots - discards) / shots AS ps_rate FROM curve)
"""


def event_curve(spark, sf_dir):
    return curves.sweep_curve(event_fragments(spark, sf_dir), "kind || ' d=' || d", "p")


@query(CURVE + """
    SELECT series, x, shots, errors, discards, round(error_rate, 6) AS error_rate,
           round(sqrt(error_rate * (1 - error_rate) / shots), 6) AS std_error,
           round(err_rate, 6) AS err_rate, round(ps_rate, 6) AS ps_rate
    FROM rated""")
def sweep_curve(spark, sf_dir):
    """Error rate against p, one series per type and distance."""
    return event_curve(spark, sf_dir).select(
        "series", "x", "shots", "errors", "discards",
        *[F.round(c, 6).alias(c) for c in ("error_rate", "std_error", "err_rate", "ps_rate")],
    )


@query(FRAG + """
    SELECT p AS x, """ + ", ".join(
        f"round(sum(errors) FILTER (WHERE d = {d}) / sum(shots) FILTER (WHERE d = {d}), 6) AS d{d}" for d in grid.DISTANCES
    ) + " FROM fragments GROUP BY p")
def sweep_curve_table(spark, sf_dir):
    """The same as a table with one column per distance."""
    points = materialize(curves.sweep_curve(event_fragments(spark, sf_dir), "concat('d', d)", "p"), "points")
    series = sorted((r.series for r in points.select("series").distinct().collect()), key=lambda s: int(s[1:]))  # the distances of the sweep
    wide = curves.curve_table(points, series)
    return wide.select("x", *[F.round(s, 6).alias(s) for s in series])


@query(CURVE + """,
    ends AS (SELECT series, arg_min(err_rate, x) AS first_rate, arg_max(err_rate, x) AS last_rate,
                    count(*) FILTER (WHERE ps_rate > 0.35 OR ps_rate < 0.05) AS ps_out,
                    count(*) FILTER (WHERE coalesce(err_rate >= 0.30, TRUE)) AS err_out
             FROM rated GROUP BY series)
    SELECT * FROM (
      SELECT series, 'ps_rate in range' AS rule, 'warning' AS severity, CAST(ps_out AS BIGINT) AS n_points FROM ends
      UNION ALL SELECT series, 'err_rate below limit', 'error', CAST(err_out AS BIGINT) FROM ends
      UNION ALL SELECT series, 'err_rate rising', 'error', CASE WHEN first_rate < last_rate THEN 0 ELSE 1 END FROM ends)
    WHERE n_points > 0""")
def sweep_sanity(spark, sf_dir):
    """V6: failed checks of each curve with their severity."""
    return curves.sanity(event_curve(spark, sf_dir))


@query(CURVE + """
    SELECT series, round(arg_min(err_rate, x), 6) AS first_rate, round(arg_max(err_rate, x), 6) AS last_rate
    FROM rated GROUP BY series""")
def sweep_end_points(spark, sf_dir):
    """Rates at the smallest and the largest p."""
    ends = curves.end_points(event_curve(spark, sf_dir))
    return ends.select("series", F.round("first_rate", 6).alias("first_rate"), F.round("last_rate", 6).alias("last_rate"))


@query(FRAG + """,
    cells AS (SELECT d, p, sum(shots) AS shots, count(*) AS n_rows FROM fragments GROUP BY ALL),
    axes AS (SELECT * FROM (SELECT DISTINCT d FROM cells) CROSS JOIN (SELECT DISTINCT p FROM cells))
    SELECT d, p, CAST(coalesce(shots, 0) AS BIGINT) AS shots, CAST(coalesce(n_rows, 0) AS BIGINT) AS n_rows
    FROM axes LEFT JOIN cells USING (d, p)""")
def grid_coverage(spark, sf_dir):
    """The parameter grid of the observed axis values, with the shots of each cell."""
    return grid.grid_coverage(event_fragments(spark, sf_dir), "d", "p")


@query("""
    WITH jobs AS (
      SELECT event_type AS run_id, user_id % 7 AS job_id, epoch(min(ts)) AS start_s, epoch(max(ts)) AS end_s, sum(value) AS seconds
      FROM events GROUP BY ALL),
    runs AS (
      SELECT run_id, count(*) AS instances, max(end_s) - min(start_s) AS wall, sum(seconds) / 3600 AS hours,
             max(seconds) AS slowest, arg_max(job_id, (round(seconds, 4), -job_id)) AS slowest_job, max(seconds) / avg(seconds) AS imbalance
      FROM jobs GROUP BY run_id)
    SELECT run_id, CAST(instances AS BIGINT) AS instances, round(wall, 3) AS wall_seconds, round(hours, 6) AS compute_hours,
           round(slowest, 4) AS slowest_seconds, slowest_job, round(imbalance, 6) AS imbalance,
           round(hours * 0.2, 6) AS cost, round(wall - slowest, 3) AS overhead_seconds,
           round((SELECT wall FROM runs WHERE run_id = 'view') / wall, 6) AS speed_up
    FROM runs""")
def run_ledger(spark, sf_dir):
    """Wall time, compute hours, cost, speed-up and straggler of each run."""
    ts = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    jobs = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("run_id"), (F.col("user_id") % 7).alias("job_id"))
        .agg(F.min(ts).alias("start_s"), F.max(ts).alias("end_s"), F.round(F.sum("value"), 4).alias("seconds"))
    )
    runs = ledger.run_ledger(jobs, "view", 0.2)
    return runs.select(
        "run_id", "instances", "slowest_job",
        *[F.round(c, 3).alias(c) for c in ("wall_seconds", "overhead_seconds")],
        F.round("slowest_seconds", 4).alias("slowest_seconds"),
        *[F.round(c, 6).alias(c) for c in ("compute_hours", "imbalance", "cost", "speed_up")],
    )


@query(FRAG + """
    SELECT strong_id, CAST(day AS VARCHAR) AS day, rule FROM (
      SELECT *, unnest([
        CASE WHEN errors + discards > shots THEN 'errors and discards above shots' END,
        CASE WHEN shots > 3 THEN 'shots above budget' END]) AS rule FROM fragments)
    WHERE rule IS NOT NULL""")
def counter_violations(spark, sf_dir):
    """counter rows outside their ranges or over a budget of 3 shots."""
    rows = event_fragments(spark, sf_dir)
    return checks.violations(rows.withColumn("day", F.col("day").cast("string")), ["strong_id", "day"], checks.stats_rules(3))


@query("""
    WITH seen AS (SELECT l_orderkey, l_shipdate, l_suppkey % 10 AS file FROM lineitem)
    SELECT 'all' AS part, count(DISTINCT l_orderkey) AS n_keys, true AS near FROM seen
    UNION ALL SELECT 'even', count(DISTINCT l_orderkey), true FROM seen WHERE file % 2 = 0""")
def distinct_sketch(spark, sf_dir):
    """Sketches of the ids stored per file, united over all files and over half of them, within three percent of the exact count."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 10).alias("file"))
    stored = materialize(C.distinct_sketches(rows, ["file"], "l_orderkey"), "sketches")

    def compared(part, some):
        about = C.distinct_estimate(stored.filter(some)).select(F.lit(part).alias("part"), "about")
        exact = rows.filter(some).agg(F.count_distinct("l_orderkey").alias("n_keys")).select(F.lit(part).alias("part"), "n_keys")
        return exact.join(about, "part").select("part", "n_keys", (F.abs(F.col("about") - F.col("n_keys")) <= 0.03 * F.col("n_keys")).alias("near"))

    return compared("all", F.lit(True)).unionByName(compared("even", F.col("file") % 2 == 0))


@query("WITH " + ROUNDS_SQL + f""",
    grid AS (SELECT * FROM (SELECT unnest({[*grid.ROUNDS, 6]}) AS K) CROSS JOIN (SELECT unnest({list(grid.SEQUENCE_RATES)})::DOUBLE AS p))
    SELECT CAST(K AS BIGINT) AS K, p, count(p_partkey) AS n_parts, count(p_partkey) = 0 AS open FROM grid LEFT JOIN rounds USING (K, p) GROUP BY K, p""")
def parameter_grid(spark, sf_dir):
    """Every planned combination of rounds and rate, with the parts that have it; those without any are still open."""
    planned = grid.parameter_grid(spark, K=[*grid.ROUNDS, 6], p=list(grid.SEQUENCE_RATES))
    done = rounds(table(spark, sf_dir, "part")).groupBy("K", "p").agg(F.count("*").alias("n_parts"))
    cells = planned.join(done, ["K", "p"], "left").na.fill(0, ["n_parts"])
    return cells.select(F.col("K").cast("long").alias("K"), "p", "n_parts", (F.col("n_parts") == 0).alias("open"))
