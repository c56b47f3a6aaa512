"""Two backends on the line items: detector, total, seed, case and channel comparisons.

A line item is one shot of detector `l_linenumber` in trial `l_suppkey % 10`. Both
backends see each shot (backend a fires on the discount, b on the tax), so their
numbers of shots are equal, as the pooled formulas need. For the unpooled ones the
line status splits the shots in two sets of different size.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.functions import rates, zscores as Z
from tallygrid.operators import compare
from tallygrid.workload import query
from tallygrid.workload.views import fired_a, fired_b, table


def trial():
    return (F.col("l_suppkey") % 10).alias("trial")


def detector():
    return F.col("l_linenumber").cast("bigint")


def both(spark, sf_dir, *keys):
    """Shots and events of both backends per cell."""
    return table(spark, sf_dir, "lineitem").groupBy(*keys).agg(
        F.count("*").alias("trials"), F.count_if(fired_a()).alias("a"), F.count_if(fired_b()).alias("b")
    )


def both_sql(keys: str) -> str:
    return f"""
      SELECT {keys}, CAST(count(*) AS BIGINT) AS trials, CAST(count(*) FILTER (WHERE l_discount >= 0.05) AS BIGINT) AS a,
             CAST(count(*) FILTER (WHERE l_tax >= 0.04) AS BIGINT) AS b
      FROM lineitem GROUP BY ALL"""


DETECTORS = "WITH cells AS (" + both_sql("l_suppkey % 10 AS trial, CAST(l_linenumber AS BIGINT) AS det_id") + """),
    rated AS (SELECT *, a / trials AS rate_a, b / trials AS rate_b, greatest(a / trials, b / trials, 1e-6) AS pm FROM cells),
    scored AS (SELECT *, sqrt(pm * (1 - pm) / trials) AS sigma FROM rated),
    z AS (SELECT *, CASE WHEN sigma > 0 THEN abs(rate_a - rate_b) / sigma ELSE 0 END AS z FROM scored)
"""


def detector_cells(spark, sf_dir):
    cells = both(spark, sf_dir, trial(), detector().alias("det_id"))
    return compare.detector_deviation(cells.withColumn("n_a", F.col("trials")).withColumn("n_b", F.col("trials")))


@query(DETECTORS + "SELECT trial, det_id, trials, a, b, round(rate_a, 6) AS rate_a, round(rate_b, 6) AS rate_b, round(z, 6) AS z FROM z")
def backend_z_max_p(spark, sf_dir):
    """Per-detector rates of two backends and their distance."""
    return detector_cells(spark, sf_dir).select(
        "trial", "det_id", "trials", "a", "b", *[F.round(c, 6).alias(c) for c in ("rate_a", "rate_b", "z")]
    )


@query(DETECTORS + "SELECT trial, det_id, a, b, round(z, 6) AS z FROM z WHERE z > 1.0 ORDER BY trial, det_id LIMIT 10")
def backend_worst_detectors(spark, sf_dir):
    """F8, O2: report of the first ten detectors beyond a threshold."""
    worst = compare.worst_detectors(detector_cells(spark, sf_dir), ["trial", "det_id"], 10, 1.0)
    return worst.select("trial", "det_id", "a", "b", F.round("z", 6).alias("z"))


TOTALS = "WITH t AS (" + both_sql("l_suppkey % 10 AS trial") + """),
    p AS (SELECT *, a / trials AS p1, (a + b) / (2 * trials) AS pp FROM t),
    s AS (SELECT *, sqrt(2 * trials * p1 * (1 - p1)) AS s1, sqrt(2 * trials * pp * (1 - pp)) AS sp FROM p),
    z AS (SELECT *, CASE WHEN s1 > 0 THEN (a - b) / s1 ELSE 0 END AS z_rate_first,
                 CASE WHEN sp > 0 THEN (a - b) / sp ELSE 0 END AS z_pooled,
                 CASE WHEN a > 0 THEN (a - b) / a ELSE 0 END AS rel_dev FROM s)
"""


@query(TOTALS + """
    SELECT trial, trials, a, b, round(abs(z_rate_first), 6) AS z_first, round(z_rate_first, 6) AS z_rate_first,
           round(z_pooled, 6) AS z_pooled, round(rel_dev, 6) AS rel_dev,
           CASE WHEN abs(z_pooled) > 5 THEN 'confirmed' WHEN abs(z_pooled) > 3 THEN 'likely' ELSE 'none' END AS verdict
    FROM z""")
def backend_z_pooled(spark, sf_dir):
    """Totals per trial under the three estimates of p, and the verdict."""
    scored = compare.total_deviation(both(spark, sf_dir, trial()))
    return scored.select(
        "trial", "trials", "a", "b", *[F.round(c, 6).alias(c) for c in ("z_first", "z_rate_first", "z_pooled", "rel_dev")],
        Z.confirmation_verdict(F.col("z_pooled")).alias("verdict"),
    )


@query(TOTALS + """
    SELECT trial, printf('%.4f', a / trials) AS rate_a, printf('%.4f', b / trials) AS rate_b, printf('%+.2f%%', rel_dev * 100) AS deviation FROM z""")
def backend_report(spark, sf_dir):
    """Rates and deviations of the trials as report text."""
    scored = compare.total_deviation(both(spark, sf_dir, trial()))
    return scored.select(
        "trial", rates.rate_report(rates.error_rate(F.col("a"), F.col("trials"))).alias("rate_a"),
        rates.rate_report(rates.error_rate(F.col("b"), F.col("trials"))).alias("rate_b"), rates.percent_text(F.col("rel_dev")).alias("deviation"),
    )


@query(TOTALS + """
    SELECT CAST(count(*) AS BIGINT) AS seeds, round(avg(z_pooled), 6) AS mean_z, round(stddev_pop(z_pooled), 6) AS std_z,
           round(avg(rel_dev), 6) AS mean_rel_dev,
           CASE WHEN avg(z_pooled) > 1.5 THEN 'systematic: a above b' WHEN avg(z_pooled) < -1.5 THEN 'systematic: a below b'
                ELSE 'statistical' END AS verdict
    FROM z""")
def seed_bias(spark, sf_dir):
    """Mean and spread of the per-trial z, bias or noise."""
    return compare.seed_summary(both(spark, sf_dir, trial())).select(
        "seeds", "verdict", *[F.round(c, 6).alias(c) for c in ("mean_z", "std_z", "mean_rel_dev")]
    )


UNPOOLED = """
    WITH cells AS (
      SELECT CAST(l_linenumber AS BIGINT) AS det_id,
             CAST(count(*) FILTER (WHERE l_linestatus = 'F') AS BIGINT) AS n_a, CAST(count(*) FILTER (WHERE l_linestatus = 'O') AS BIGINT) AS n_b,
             CAST(count(*) FILTER (WHERE l_linestatus = 'F' AND l_discount >= 0.05) AS BIGINT) AS a,
             CAST(count(*) FILTER (WHERE l_linestatus = 'O' AND l_discount >= 0.05) AS BIGINT) AS b
      FROM lineitem GROUP BY ALL),
    rated AS (SELECT *, a / n_a AS rate_a, b / n_b AS rate_b FROM cells),
    s AS (SELECT *, sqrt(rate_a * (1 - rate_a) / n_a + rate_b * (1 - rate_b) / n_b) AS sigma FROM rated),
    z AS (SELECT *, CASE WHEN sigma > 0 THEN (rate_a - rate_b) / sigma ELSE 0 END AS z,
                 CASE WHEN rate_a > 0 THEN (rate_a - rate_b) / rate_a ELSE 0 END AS rel_dev FROM s)
"""
UNPOOLED_ROWS = UNPOOLED + """
    SELECT det_id, n_a, n_b, a, b, round(rate_a, 6) AS rate_a, round(rate_b, 6) AS rate_b, round(z, 6) AS z, round(rel_dev, 6) AS rel_dev
    FROM z"""


def status_cells(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("det_id", detector())
    return compare.rate_deviation(compare.backend_counts(lines, ["det_id"], "l_linestatus", fired_a(), "F", "O"))


def rounded_cells(cells):
    return cells.select("det_id", "n_a", "n_b", "a", "b", *[F.round(c, 6).alias(c) for c in ("rate_a", "rate_b", "z", "rel_dev")])


@query(UNPOOLED_ROWS)
def backend_z_unpooled(spark, sf_dir):
    """Two backends in one table, each rate with its own standard error."""
    return rounded_cells(status_cells(spark, sf_dir))


@query(UNPOOLED_ROWS)
def backend_join(spark, sf_dir):
    """The same from two tables of counts, joined on the detector."""

    def counts(status):
        lines = table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == status)
        return lines.groupBy(detector().alias("det_id")).agg(F.count("*").alias("shots"), F.count_if(fired_a()).alias("events"))

    return rounded_cells(compare.rate_deviation(compare.join_backends(counts("F"), counts("O"), ["det_id"])))


@query(UNPOOLED + """
    SELECT round(max(abs(z)), 6) AS worst_z, round(max(abs(rel_dev)), 6) AS worst_rel,
           CASE WHEN max(abs(z)) < 3 THEN 'agree' WHEN max(abs(rel_dev)) < 0.08 THEN 'mechanical only' ELSE 'unusable' END AS verdict
    FROM z""")
def backend_worst_case(spark, sf_dir):
    """Worst distance and deviation over all detectors, and the verdict ladder."""
    worst = compare.worst_case(status_cells(spark, sf_dir))
    return worst.select(F.round("worst_z", 6).alias("worst_z"), F.round("worst_rel", 6).alias("worst_rel"), "verdict")


@query("WITH t AS (" + both_sql("l_suppkey % 10 AS trial, CAST(l_linenumber AS BIGINT) AS det_id") + """),
    g AS (SELECT det_id, count(*) AS n_trials, stddev_samp(a / trials) AS trial_std, avg(a / trials) AS mean_rate, avg(trials) AS mean_trials
          FROM t GROUP BY det_id)
    SELECT det_id, CAST(n_trials AS BIGINT) AS n_trials, round(trial_std, 6) AS trial_std,
           round(sqrt(mean_rate * (1 - mean_rate) / mean_trials), 6) AS expected_std,
           round(trial_std / sqrt(mean_rate * (1 - mean_rate) / mean_trials), 6) AS excess
    FROM g""")
def variance_excess(spark, sf_dir):
    """Spread of the trial rates over the spread that counting explains."""
    trials = both(spark, sf_dir, trial(), detector().alias("det_id")).withColumn("events", F.col("a"))
    spread = compare.variance_excess(trials, ["det_id"])
    return spread.select("det_id", "n_trials", *[F.round(c, 6).alias(c) for c in ("trial_std", "expected_std", "excess")])


@query("""
    WITH cases AS (
      SELECT l_returnflag, l_linestatus,
             count(*) FILTER (WHERE l_discount >= 0.05) AS a_det, count(*) FILTER (WHERE l_tax >= 0.04) AS b_det,
             count(*) FILTER (WHERE l_quantity >= 45 AND l_linestatus = 'F') AS a_obs, count(*) FILTER (WHERE l_quantity <= 6) AS b_obs
      FROM lineitem GROUP BY ALL),
    devs AS (SELECT abs(CASE WHEN a_det > 0 THEN (a_det - b_det) / a_det ELSE 0 END) AS det,
                    CASE WHEN a_obs > 0 THEN abs((a_obs - b_obs) / a_obs) END AS obs FROM cases)
    SELECT round(avg(det), 6) AS mean_det_dev, round(avg(obs), 6) AS mean_obs_dev,
           CASE WHEN avg(obs) < 0.05 THEN 'usable' WHEN avg(obs) IS NOT NULL THEN 'not usable' ELSE 'no flips' END AS verdict
    FROM devs""")
def case_summary(spark, sf_dir):
    """Mean deviation over cases; cases without reference flips do not count."""
    cases = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count_if(fired_a()).alias("a_det"), F.count_if(fired_b()).alias("b_det"),
        F.count_if((F.col("l_quantity") >= 45) & (F.col("l_linestatus") == "F")).alias("a_obs"),
        F.count_if(F.col("l_quantity") <= 6).alias("b_obs"),
    )
    summary = compare.case_summary(cases)
    return summary.select(F.round("mean_det_dev", 6).alias("mean_det_dev"), F.round("mean_obs_dev", 6).alias("mean_obs_dev"), "verdict")


@query("WITH t AS (" + both_sql("l_returnflag AS channel") + """),
    z AS (SELECT *, (a + b) / (2 * trials) AS p FROM t),
    s AS (SELECT *, (a - b) / sqrt(2 * trials * p * (1 - p)) AS z FROM z),
    off AS (SELECT a, b FROM t WHERE channel = 'N')
    SELECT channel, a, b, trials, round(z, 6) AS z_pooled, a = b AS exact,
           a - (SELECT a FROM off) AS a_over_baseline, b - (SELECT b FROM off) AS b_over_baseline,
           CASE WHEN abs(z) > 5 THEN 'confirmed' WHEN abs(z) > 3 THEN 'likely' ELSE 'none' END AS verdict
    FROM s""")
def channel_isolation(spark, sf_dir):
    """One channel at a time against the all-off channel `N`."""
    cells = both(spark, sf_dir, F.col("l_returnflag").alias("channel"), detector().alias("det_id"))
    report = compare.channel_isolation(cells, "N")
    return report.select(
        "channel", "a", "b", "trials", F.round("z_pooled", 6).alias("z_pooled"), "exact", "a_over_baseline", "b_over_baseline", "verdict"
    )
