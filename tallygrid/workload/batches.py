"""Batches of the part experiments, by count and by cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.functions.names import display_label
from tallygrid.operators import balance as B
from tallygrid.plans import collect as P, launch, merge as M
from tallygrid.sinks.stats import write_batches
from tallygrid.session import new_path
from tallygrid.workload import query
from tallygrid.workload.views import ITEMS_SQL, items, table

WITH = "WITH " + ITEMS_SQL
PATH = ["path"]
KEY = ["p_partkey"]
BATCHES = 5

ROBIN = WITH + """,
    robin AS (SELECT *, (row_number() OVER (ORDER BY path) - 1) % 7 AS batch_id FROM items)
"""


def part_items(spark, sf_dir):
    return items(table(spark, sf_dir, "part"))


def lpt_sql(source: str, group: str, batches: int) -> str:
    """Greedy longest-first assignment, one item per recursion step and group."""
    loads = ", ".join(["CAST(0 AS DOUBLE)"] * batches)
    return f"""WITH RECURSIVE {source},
    ranked AS (SELECT *, {group} AS g, row_number() OVER (PARTITION BY {group} ORDER BY seconds DESC, p_partkey) AS rn FROM candidates),
    lpt AS (
      SELECT g, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS p_partkey, CAST(NULL AS BIGINT) AS batch_id, [{loads}] AS loads
      FROM (SELECT DISTINCT g FROM ranked)
      UNION ALL
      SELECT r.g, r.rn, r.p_partkey, list_position(l.loads, list_min(l.loads)) - 1,
             list_transform(l.loads, lambda x, i: CASE WHEN i = list_position(l.loads, list_min(l.loads)) THEN x + r.seconds ELSE x END)
      FROM lpt l JOIN ranked r ON r.g = l.g AND r.rn = l.rn + 1),
    assigned AS (SELECT ranked.*, CAST(lpt.batch_id AS BIGINT) AS batch_id FROM lpt JOIN ranked USING (g, rn))
"""


CANDIDATES = ITEMS_SQL + ", candidates AS (SELECT * FROM items)"
BY_SWEEP = lpt_sql(CANDIDATES, "sweep", BATCHES)
LOADS = """,
    sweeps AS (SELECT DISTINCT sweep FROM items),
    every AS (SELECT sweep, unnest(range(0, {n})) AS batch_id FROM sweeps),
    loads AS (
      SELECT every.sweep, CAST(every.batch_id AS BIGINT) AS batch_id, CAST(count(a.p_partkey) AS BIGINT) AS n_items, coalesce(sum(a.seconds), 0) AS load
      FROM every LEFT JOIN assigned a ON a.sweep = every.sweep AND a.batch_id = every.batch_id GROUP BY ALL)
"""


@query(ROBIN + "SELECT path, batch_id FROM robin")
def round_robin(spark, sf_dir):
    """Position in the global path order, modulo seven batches."""
    return B.round_robin(part_items(spark, sf_dir), PATH, batches=7).select("path", "batch_id")


@query(WITH + """,
    n AS (SELECT CAST(ceil(count(*) / 6) AS BIGINT) AS n FROM items),
    robin AS (SELECT (row_number() OVER (ORDER BY path) - 1) % (SELECT n FROM n) AS batch_id FROM items)
    SELECT batch_id, CAST(count(*) AS BIGINT) AS n_items FROM robin GROUP BY batch_id""")
def round_robin_sizes(spark, sf_dir):
    """Batches of at most six experiments, and their sizes."""
    return B.batch_sizes(B.round_robin(part_items(spark, sf_dir), PATH, per_batch=6))


def lpt_by_sweep(spark, sf_dir):
    return B.longest_first(part_items(spark, sf_dir), "seconds", KEY, BATCHES, ["sweep"])


@query(BY_SWEEP + "SELECT sweep, p_partkey, seconds, batch_id FROM assigned")
def lpt_assign(spark, sf_dir):
    """Longest-first batches within each sweep; many equal weights."""
    return lpt_by_sweep(spark, sf_dir).select("sweep", "p_partkey", "seconds", "batch_id")


@query(lpt_sql(CANDIDATES, "0", 7) + "SELECT p_partkey, seconds, batch_id FROM assigned")
def lpt_one_group(spark, sf_dir):
    """All experiments in a single group of seven batches."""
    return B.longest_first(part_items(spark, sf_dir), "seconds", KEY, 7).select("p_partkey", "seconds", "batch_id")


def dear(spark, sf_dir):
    """Weights that nearly all differ: the retail price."""
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("sweep"), F.col("p_retailprice").alias("seconds"))


@query(lpt_sql("items AS (SELECT p_partkey, p_brand AS sweep, p_retailprice AS seconds FROM part), candidates AS (SELECT p_partkey, sweep, CAST(seconds AS DECIMAL(18, 4)) AS seconds FROM items)", "sweep", BATCHES).replace("CAST(0 AS DOUBLE)", "CAST(0 AS DECIMAL(18, 4))")
       + "SELECT sweep, p_partkey, CAST(seconds AS DOUBLE) AS seconds, batch_id FROM assigned")
def lpt_prices(spark, sf_dir):
    """Longest-first batches with nearly all weights different."""
    return B.longest_first(dear(spark, sf_dir), "seconds", KEY, BATCHES, ["sweep"]).select("sweep", "p_partkey", "seconds", "batch_id")


@query("""
    SELECT count(*) AS n_items, count(DISTINCT o_orderkey) AS n_keys, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS units, true AS near, true AS both
    FROM orders""")
def lpt_past_the_bound(spark, sf_dir):
    """One group with more different weights than a task may fold; no batch above 1.01 times what the greedy has at least."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).alias("units"))
    placed = B.longest_first(orders, "units", [F.col("o_orderkey")], 7, weight_unit=1.0, max_classes=300, method="method")
    loads = placed.groupBy("batch_id").agg(
        F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("keys"), F.sum("units").alias("load"), F.max("units").alias("largest"), F.min("method").alias("first"), F.max("method").alias("last")
    )
    sums = [F.sum(c).alias(name) for c, name in (("n", "n_items"), ("keys", "n_keys"), ("load", "all"))]
    every = loads.agg(*sums, F.max("load").alias("top"), F.max("largest").alias("largest"), F.min("first").alias("first"), F.max("last").alias("last"))
    near, both = F.col("top") <= 1.01 * F.greatest(F.col("all") / 7, "largest"), (F.col("first") == "exact") & (F.col("last") == "levelled")
    return every.select("n_items", "n_keys", F.col("all").cast("bigint").alias("units"), near.alias("near"), both.alias("both"))


@query(BY_SWEEP + LOADS.format(n=BATCHES) + "SELECT sweep, batch_id, n_items, load FROM loads")
def batch_loads(spark, sf_dir):
    """Items and load of every batch, empty ones included."""
    return B.batch_loads(lpt_by_sweep(spark, sf_dir), "seconds", BATCHES, ["sweep"])


@query(BY_SWEEP + LOADS.format(n=BATCHES) + """
    SELECT sweep, min(load) AS min_load, max(load) AS max_load, round(max(load) / nullif(min(load), 0), 6) AS ratio,
           round(max(load) / avg(load), 6) AS imbalance, arg_max(batch_id, (load, -batch_id)) AS slowest_batch
    FROM loads GROUP BY sweep""")
def load_balance(spark, sf_dir):
    """A10, O3: load ratio and straggler of each sweep."""
    loads = B.batch_loads(lpt_by_sweep(spark, sf_dir), "seconds", BATCHES, ["sweep"])
    report = B.load_balance(loads, ["sweep"])
    return report.withColumn("ratio", F.round("ratio", 6)).withColumn("imbalance", F.round("imbalance", 6))


TIMED = WITH + """,
    timings AS (SELECT o_orderkey AS p_partkey, round(o_totalprice, 2) AS order_seconds FROM orders WHERE o_orderkey % 3 <> 0),
    timed AS (SELECT p_partkey, sweep, path, order_seconds AS seconds FROM items JOIN timings USING (p_partkey))
"""


def part_timings(spark, sf_dir):
    """Timings from the orders, for two of three parts."""
    return table(spark, sf_dir, "orders").filter("o_orderkey % 3 <> 0").select(
        F.col("o_orderkey").alias("p_partkey"), F.round("o_totalprice", 2).alias("seconds")
    )


@query(WITH + """
    SELECT p_partkey, path, round(o_totalprice, 2) AS seconds FROM items JOIN orders ON o_orderkey = p_partkey""")
def timed_catalogue(spark, sf_dir):
    """Experiments with their measured seconds, the price of the order of the same number."""
    timings = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("p_partkey"), F.round("o_totalprice", 2).alias("seconds"))
    return B.with_timings(part_items(spark, sf_dir).drop("seconds"), timings, ["p_partkey"]).select("p_partkey", "path", "seconds")


@query(TIMED + "SELECT p_partkey, path FROM items WHERE p_partkey NOT IN (SELECT p_partkey FROM timings)")
def missing_timings(spark, sf_dir):
    """Experiments without a timing."""
    return B.missing_timings(part_items(spark, sf_dir), part_timings(spark, sf_dir), ["p_partkey"]).select("p_partkey", "path")


@query("""
    SELECT CAST(o_orderkey % 5 + 1 AS INTEGER) AS K, o_custkey / 1e6 AS p, arg_max(o_totalprice, o_orderkey) AS seconds
    FROM orders GROUP BY ALL""")
def timings_last_wins(spark, sf_dir):
    """One timing per (K, p), the last row wins."""
    rows = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("K"), (F.col("o_custkey") / 1e6).alias("p"),
        F.col("o_totalprice").alias("seconds"), "o_orderkey",
    )
    return B.latest_timings(rows, ["K", "p"], "o_orderkey")


@query(ROBIN + """,
    again AS (SELECT path, batch_id FROM robin UNION ALL SELECT path, 100 FROM robin WHERE p_partkey % 17 = 0)
    SELECT path, CAST(count(DISTINCT batch_id) AS BIGINT) AS n_batches, CAST(count(*) AS BIGINT) AS copies
    FROM again GROUP BY path HAVING count(DISTINCT batch_id) > 1""")
def shared_items(spark, sf_dir):
    """U4: experiments found in two batches; some are given to a batch 100 as well."""
    assigned = B.round_robin(part_items(spark, sf_dir), PATH, batches=7)
    again = assigned.filter("p_partkey % 17 = 0").withColumn("batch_id", F.lit(100).cast("bigint"))
    return B.shared_items(assigned.unionByName(again))


@query(ROBIN + "SELECT batch_id, 'K=' || CAST(p_partkey AS VARCHAR) AS label FROM robin")
def batch_labels(spark, sf_dir):
    """Short labels of the experiments of each batch."""
    assigned = B.round_robin(part_items(spark, sf_dir), PATH, batches=7)
    label = F.concat(F.lit("K="), display_label(F.col("path"), "part_", "circuit"))
    return B.batch_labels(assigned, label)


@query(ROBIN + """
    SELECT 'run1' AS run_id, batch_id, CAST(count(*) AS BIGINT) AS n_items, CAST(sum(p_partkey) AS BIGINT) AS key_sum
    FROM robin GROUP BY batch_id
    UNION ALL
    SELECT 'run2', batch_id, CAST(count(*) AS BIGINT), CAST(sum(p_partkey) AS BIGINT) FROM robin WHERE p_partkey % 2 = 0 GROUP BY batch_id""")
def batch_folders(spark, sf_dir):
    """K3, K4: batch folders of two runs, written and read back from their directories."""
    assigned = B.round_robin(part_items(spark, sf_dir), PATH, batches=7)
    out = new_path(spark, "folders")
    write_batches(assigned, out, "run1")
    write_batches(assigned, out, "run2")
    write_batches(assigned.filter("p_partkey % 2 = 0"), out, "run2")
    read = spark.read.schema("sweep string, p_partkey bigint, seconds double, path string, run_id string, batch_id bigint").parquet(out)
    return read.groupBy("run_id", "batch_id").agg(F.count("*").alias("n_items"), F.sum("p_partkey").alias("key_sum"))


def sampler(per_second: int):
    """A sampler whose counters follow from the task row, so that SQL can repeat them."""

    def sample(frames):
        import pandas as pd

        for tasks in frames:
            shots = tasks["remaining_shots"].clip(upper=tasks["cost"] * per_second)
            yield pd.DataFrame(
                {
                    "shots": shots, "errors": shots // 7, "discards": shots % 5, "seconds": tasks["cost"] * 1.0,
                    "decoder": tasks["decoder"], "strong_id": tasks["strong_id"], "json_metadata": "{}", "custom_counts": '{"runs":1}',
                }
            )

    return sample


def part_tasks(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("strong_id"),
        F.when(F.col("p_partkey") % 2 == 0, "fast").otherwise("slow").alias("decoder"),
        F.col("p_size").cast("bigint").alias("cost"),
        F.lit(100).cast("bigint").alias("max_shots"), F.lit(12).cast("bigint").alias("max_errors"),
    )


@query("""
    WITH tasks AS (SELECT 't' || CAST(p_partkey AS VARCHAR) AS strong_id, CASE WHEN p_partkey % 2 = 0 THEN 'fast' ELSE 'slow' END AS decoder,
                          CAST(p_size AS BIGINT) AS cost, p_partkey FROM part),
    prior AS (SELECT *, p_partkey % 101 AS s0, p_partkey % 13 AS e0, p_partkey % 4 <> 0 AS has FROM tasks),
    new AS (
      SELECT *, least(100 - CASE WHEN has THEN s0 ELSE 0 END, cost * CASE WHEN decoder = 'fast' THEN 4 ELSE 1 END) AS s1
      FROM prior WHERE NOT (has AND (s0 >= 100 OR e0 >= 12))),
    rows AS (
      SELECT strong_id, s0 AS shots, e0 AS errors, 0 AS discards FROM prior WHERE has
      UNION ALL SELECT strong_id, s1, s1 // 7, s1 % 5 FROM new)
    SELECT strong_id, CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(errors) AS BIGINT) AS errors, CAST(sum(discards) AS BIGINT) AS discards,
           '{"runs":' || CAST(count(*) AS VARCHAR) || '}' AS custom_counts
    FROM rows GROUP BY strong_id""")
def resume_collection(spark, sf_dir):
    """Open tasks sampled by the function registered for their decoder, added to the counters on disk."""
    prior = table(spark, sf_dir, "part").filter("p_partkey % 4 <> 0").select(
        F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("strong_id"),
        (F.col("p_partkey") % 101).alias("shots"), (F.col("p_partkey") % 13).alias("errors"), F.lit(0).cast("bigint").alias("discards"),
        F.lit(0.0).alias("seconds"), F.lit("prior").alias("decoder"), F.lit("{}").alias("json_metadata"), F.lit('{"runs":1}').alias("custom_counts"),
    )
    totals = P.resume(part_tasks(spark, sf_dir), prior, {"fast": sampler(4), "slow": sampler(1)})
    return totals.select("strong_id", "shots", "errors", "discards", F.to_json("custom_counts").alias("custom_counts"))


@query("""
    WITH tasks AS (SELECT 't' || CAST(p_partkey AS VARCHAR) AS strong_id, CASE WHEN p_partkey % 2 = 0 THEN 'fast' ELSE 'slow' END AS decoder,
                          CAST(p_size AS BIGINT) AS cost, p_partkey FROM part),
    prior AS (SELECT *, 2 * (p_partkey % 101) AS s0, 2 * (p_partkey % 13) AS e0 FROM tasks),
    new AS (
      SELECT *, least(100 - s0, cost * CASE WHEN decoder = 'fast' THEN 4 ELSE 1 END) AS s1 FROM prior WHERE NOT (s0 >= 100 OR e0 >= 12)),
    rows AS (
      SELECT strong_id, s0 AS shots, e0 AS errors, 2 AS runs FROM prior
      UNION ALL SELECT strong_id, s1, s1 // 7, 1 FROM new)
    SELECT strong_id, CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(errors) AS BIGINT) AS errors,
           '{"runs":' || CAST(CAST(sum(runs) AS BIGINT) AS VARCHAR) || '}' AS custom_counts
    FROM rows GROUP BY strong_id""")
def resume_merged(spark, sf_dir):
    """The counters on disk are merged totals with a counter map."""
    prior = table(spark, sf_dir, "part").select(
        F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("strong_id"),
        (F.col("p_partkey") % 101).alias("shots"), (F.col("p_partkey") % 13).alias("errors"), F.lit(0).cast("bigint").alias("discards"),
        F.lit(0.0).alias("seconds"), F.lit("prior").alias("decoder"), F.lit("{}").alias("json_metadata"), F.lit('{"runs":1}').alias("custom_counts"),
    )
    merged = M.merge(prior.unionByName(prior), with_counters=True)
    totals = P.resume(part_tasks(spark, sf_dir), merged, {"fast": sampler(4), "slow": sampler(1)})
    return totals.select("strong_id", "shots", "errors", F.to_json("custom_counts").alias("custom_counts"))


@query(lpt_sql("""items AS (SELECT p_partkey, p_size % 5 + 1 AS K, (p_partkey % 5 + 1) / 10 AS p FROM part),
    timings AS (SELECT o_orderkey % 5 + 1 AS K, (o_custkey % 5 + 1) / 10 AS p, CAST(max(o_orderkey % 997) AS DOUBLE) AS seconds FROM orders GROUP BY ALL),
    candidates AS (SELECT p_partkey, seconds FROM items JOIN timings USING (K, p))""", "0", 4) + """
    SELECT batch_id, CAST(count(*) AS BIGINT) AS n_items, sum(seconds) AS load FROM assigned GROUP BY batch_id""")
def plan_by_cost(spark, sf_dir):
    """Parts as experiments with K and p, their timings found by decimal rate, and batches of equal cost."""
    part = table(spark, sf_dir, "part").select(
        F.format_string("sweep/%06d", "p_partkey").alias("path"), (F.col("p_size") % 5 + 1).cast("int").alias("K"),
        ((F.col("p_partkey") % 5 + 1) / 10 + 0.3 - 0.3).alias("p"),  # rates as they come out of arithmetic
    )
    orders = table(spark, sf_dir, "orders")
    timings = orders.groupBy((F.col("o_orderkey") % 5 + 1).cast("int").alias("K"), ((F.col("o_custkey") % 5 + 1) / 10).alias("p")).agg(
        F.max(F.col("o_orderkey") % 997).cast("double").alias("seconds")
    )
    assigned = launch.assign_by_cost(part, timings, 4).withColumn("g", F.lit(0))
    return B.batch_loads(assigned, "seconds", 4, ["g"]).drop("g")
