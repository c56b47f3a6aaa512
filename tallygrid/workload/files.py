"""Counter files written by Spark from the events, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.functions import names as N
from tallygrid.operators import grid, profile
from tallygrid.plans import launch, merge as M
from tallygrid.schema import STATS_COLUMNS
from tallygrid.session import new_path
from tallygrid.sinks.stats import counts_as_json, write_batches, write_stats
from tallygrid.sources import catalogue as Cat, checked as K, fragments as S
from tallygrid.workload import query
from tallygrid.workload.views import ROUNDS_SQL, TOTALS_SQL, day_counts, fragment_sql, fragments, rounds, spread, table

FRAG = fragment_sql()


def counter_rows(spark, sf_dir):
    """Fragments with their counter maps as JSON text; the batch is the user modulo 7."""
    events = table(spark, sf_dir, "events")
    counts = counts_as_json(day_counts(events)).select("user_id", "day", "custom_counts")
    return fragments(events).join(counts, ["user_id", "day"]).withColumn("batch_id", F.col("user_id") % 7)


MERGED = FRAG + "," + TOTALS_SQL + """,
    c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
    counts AS (
      SELECT sha256('u' || CAST(user_id AS VARCHAR)) AS strong_id,
             '{' || string_agg('"' || event_type || '":' || CAST(n AS VARCHAR), ',' ORDER BY event_type) || '}' AS custom_counts
      FROM c GROUP BY user_id)
    SELECT strong_id, shots, errors, discards, round(seconds, 4) AS seconds, decoder, json_metadata, custom_counts
    FROM totals JOIN counts USING (strong_id)"""


@query(MERGED)
def merge_csv_folder(spark, sf_dir):
    """Fragment CSV files in batch folders, merged, written and read back."""
    root, out = new_path(spark, "fragments"), new_path(spark, "merged")
    write_batches(counter_rows(spark, sf_dir).select(*STATS_COLUMNS, "batch_id"), root, fmt="csv")
    merged = M.merge(S.read_fragments(spark, root, "any"), with_counters=True)
    write_stats(counts_as_json(merged), out, "csv")
    return S.read_fragments(spark, out, "any").drop("file_path").withColumn("seconds", F.round("seconds", 4))


@query(FRAG + """
    SELECT kind || ' d=' || CAST(d AS VARCHAR) AS series, p AS x, CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(errors) AS BIGINT) AS errors,
           round(sum(errors) / sum(shots), 6) AS error_rate
    FROM fragments GROUP BY ALL""")
def metadata_curves(spark, sf_dir):
    """Curves grouped by expressions on the JSON metadata."""
    points = M.curves(fragments(table(spark, sf_dir, "events")))
    return points.select("series", "x", "shots", "errors", F.round("error_rate", 6).alias("error_rate"))


@query(FRAG + """,
    damaged AS (
      SELECT *, CASE WHEN user_id % 10 = 3 AND day(day) % 5 = 0 THEN 'cut' WHEN user_id % 10 = 7 AND day(day) % 4 = 0 THEN 'json' ELSE 'good' END AS state
      FROM fragments)
    SELECT state = 'good' AS good, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(sum(CASE WHEN state <> 'cut' THEN shots ELSE day(day) END) AS BIGINT) AS shots
    FROM damaged GROUP BY state = 'good'""")
def malformed_rows(spark, sf_dir):
    """Padded rows, some cut after the first number, some cut inside their last quoted field."""
    quote = F.lit('"')
    field = F.concat(quote, F.regexp_replace("json_metadata", '"', '""'), quote)
    line = F.concat(
        F.format_string("%10d,%6d,%6d,%9.3f,", "shots", "errors", "discards", "seconds"),
        F.concat_ws(",", "decoder", "strong_id", field), F.lit(',"{""n"":1}"'),
    )
    day = F.dayofmonth("day")
    cut = (F.col("user_id") % 10 == 3) & (day % 5 == 0)
    broken = (F.col("user_id") % 10 == 7) & (day % 4 == 0)
    damaged = F.when(cut, F.format_string("%d", day)).when(broken, F.substring(line, F.lit(1), F.length(line) - 2)).otherwise(line)
    root = new_path(spark, "damaged")
    fragments(table(spark, sf_dir, "events")).select(damaged.alias("line")).write.text(root)
    raw = S.read_raw(spark, root, "*", header=False)
    rows = raw.withColumn("good", S.is_good(raw.columns))
    return rows.groupBy("good").agg(F.count("*").alias("n_rows"), F.sum("shots").alias("shots"))


SNAPSHOT_TOTALS = FRAG + """
    SELECT strong_id, CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(errors) AS BIGINT) AS errors
    FROM fragments WHERE user_id % 7 <> 0 OR day(day) <= 20 GROUP BY strong_id"""

# Days of the month at which a cumulative snapshot is written; the last covers every day.
SNAPSHOT_DAYS = (10, 20, 31)


def write_snapshots(spark, sf_dir):
    """Cumulative snapshots per batch; the last is final, but batch 0 stopped after the second."""
    rows = counter_rows(spark, sf_dir)
    seq = F.explode(F.array(*[F.lit(d) for d in SNAPSHOT_DAYS]))
    snapshots = rows.select("*", seq.alias("seq")).filter("dayofmonth(day) <= seq and (batch_id <> 0 or seq < 31)")
    root = new_path(spark, "snapshots")
    keyed = snapshots.withColumn("is_final", F.col("seq") == 31).select(*STATS_COLUMNS, "batch_id", "is_final", "seq")
    writer = keyed.hint("rebalance", "batch_id", "seq").write.option("header", True).option("escape", '"')
    writer.partitionBy("batch_id", "is_final", "seq").csv(root)
    return root


@query(SNAPSHOT_TOTALS)
def latest_snapshot(spark, sf_dir):
    """The newest snapshot of each batch, all its rows summed; superseded files are not read."""
    root = write_snapshots(spark, sf_dir)
    rows = S.read_latest(spark, root, S.partition_snapshot_key)
    return M.merge(rows).select("strong_id", "shots", "errors")


@query(FRAG + """,
    per_batch AS (SELECT user_id % 7 AS batch_id, count(*) AS n FROM fragments GROUP BY 1)
    SELECT CAST(n AS BIGINT) AS n_rows, CAST(2 AS BIGINT) AS n_files FROM per_batch WHERE batch_id IN (1, 3)""")
def duplicate_folders(spark, sf_dir):
    """Two batch folders that were copied under another batch id."""
    root = new_path(spark, "copies")
    rows = counter_rows(spark, sf_dir)
    copies = rows.filter("batch_id in (1, 3)").withColumn("batch_id", F.col("batch_id") + 100)
    write_batches(rows.unionByName(copies).select(*STATS_COLUMNS, "batch_id"), root, fmt="csv")
    raw = S.read_raw(spark, root)
    return S.duplicate_files(raw, unit=F.regexp_replace("file_path", "/[^/]+$", "")).select("n_rows", "n_files")


@query("WITH " + ROUNDS_SQL + """
    SELECT CAST(K AS BIGINT) AS K, p, CAST(count(*) AS BIGINT) AS n_files, CAST(sum(K) AS BIGINT) AS observables FROM rounds GROUP BY K, p""")
def catalogue_scan(spark, sf_dir):
    """Instruction texts as they come from a catalogue, keyed by name and read for their size."""
    part = spread(rounds(table(spark, sf_dir, "part")))
    catalogue = part.select(
        F.concat_ws("/", F.lit("sweep"), F.col("p_partkey").cast("string"), grid.sequence_name(F.col("K"), F.col("p"), "sequence")).alias("path"),
        grid.sequence_text(F.col("K"), F.col("p")).alias("text"),
    )
    good, _ = Cat.split_by_name(profile.profile(catalogue), N.parse_underscore_name, ["K", "p"])
    keys = [N.meta_value("meta", "K", "bigint").alias("K"), N.meta_value("meta", "p", "double").alias("p")]
    return good.groupBy(*keys).agg(F.count("*").alias("n_files"), F.sum("n_observables").alias("observables"))


@query("WITH " + ROUNDS_SQL + """
    SELECT DISTINCT CAST(K AS BIGINT) AS K, p, CAST(21 * K + 3 AS BIGINT) AS n_lines, CAST(4 * K AS BIGINT) AS n_detectors, CAST(12 * K AS BIGINT) AS t_count
    FROM rounds""")
def catalogue_files(spark, sf_dir):
    """One instruction file per (K, p) of the parts, read back as a catalogue; the folders hold the parameters."""
    root = new_path(spark, "catalogue")
    cells = rounds(table(spark, sf_dir, "part")).select("K", "p").distinct()
    texts = cells.select(F.col("K"), N.rate_text(F.col("p")).alias("p"), grid.sequence_text(F.col("K"), F.col("p")).alias("text"))
    texts.write.partitionBy("K", "p").text(root)

    def folder_fields(path):
        return F.str_to_map(F.regexp_extract(path, "K=[^/]+/p=[^/]+", 0), F.lit("/"), F.lit("="))

    good, _ = Cat.split_by_name(Cat.read_catalogue(spark, root, "txt"), folder_fields, ["K", "p"])
    keys = [N.meta_value("meta", "K", "bigint").alias("K"), N.meta_value("meta", "p", "double").alias("p")]
    return profile.profile(good.select(*keys, "text")).select("K", "p", "n_lines", "n_detectors", "t_count")


@query(fragment_sql(", CASE WHEN event_id % 2 = 0 THEN 'run 1' ELSE 'run 2' END AS run") + """
    SELECT strong_id, CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(errors) AS BIGINT) AS errors, min(CASE WHEN user_id % 3 = 0 THEN 'null' ELSE json_metadata END) AS json_metadata
    FROM fragments WHERE run = 'run 1' OR day(day) <= 20 GROUP BY strong_id""")
def merge_runs(spark, sf_dir):
    """Two runs with equal batch ids, the second without a final snapshot, folders with blanks, metadata that is JSON null."""
    events = table(spark, sf_dir, "events").withColumn("run", F.when(F.col("event_id") % 2 == 0, "run 1").otherwise("run 2"))
    rows = fragments(events, "run").withColumn("batch_id", F.col("user_id") % 7).withColumn("custom_counts", F.lit("{}"))
    rows = rows.withColumn("json_metadata", F.when(F.col("user_id") % 3 == 0, "null").otherwise(F.col("json_metadata")))
    seq = F.explode(F.array(*[F.lit(d) for d in SNAPSHOT_DAYS]))
    snapshots = rows.select("*", seq.alias("seq")).filter("dayofmonth(day) <= seq and (run = 'run 1' or seq < 31)")
    root = new_path(spark, "two runs")
    keyed = snapshots.withColumn("is_final", F.col("seq") == 31).select(*STATS_COLUMNS, "run", "batch_id", "is_final", "seq")
    keyed.hint("rebalance", "run", "batch_id", "seq").write.option("header", True).option("escape", '"').partitionBy("run", "batch_id", "is_final", "seq").csv(root)
    return M.merge(S.read_latest(spark, root, S.partition_snapshot_key)).select("strong_id", "shots", "errors", "json_metadata")


def part_files(spark, sf_dir):
    """A catalogue of text files, one for each brand and size of the parts, in folders that are named like them."""
    root = new_path(spark, "sweep")
    cells = table(spark, sf_dir, "part").select("p_brand", "p_size").distinct()
    cells.select("p_brand", "p_size", F.lit("M 0").alias("text")).write.partitionBy("p_brand", "p_size").text(root)
    return root


@query("""
    WITH cells AS (SELECT DISTINCT p_brand, p_size FROM part),
    n AS (SELECT CAST(ceil(count(*) / 6) AS BIGINT) AS n FROM cells),
    robin AS (SELECT (row_number() OVER (ORDER BY p_brand, p_size) - 1) % (SELECT n FROM n) AS batch_id FROM cells)
    SELECT 'b' || CAST(batch_id AS VARCHAR) AS batch_id, CAST(count(*) AS BIGINT) AS n_items FROM robin GROUP BY batch_id""")
def plan_by_count(spark, sf_dir):
    """Files of a catalogue dealt to batches of at most six, written to folders with a prefix and read back."""
    root, out = part_files(spark, sf_dir), new_path(spark, "batches")
    launch.plan_by_count(spark, root, "txt", out, per_batch=6, prefix="b")
    return spark.read.schema("path string, text string, batch_id string").parquet(out).groupBy("batch_id").agg(F.count("*").alias("n_items"))


@query("""
    SELECT CAST(o_orderkey % 5 + 1 AS INTEGER) AS K, CAST(round(o_custkey / 1e6, 6) AS DOUBLE) AS p, max(o_totalprice) AS seconds
    FROM orders GROUP BY ALL""")
def timings_file(spark, sf_dir):
    """A timing table from CSV files."""
    path = new_path(spark, "timings")
    rows = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 5 + 1).alias("K"), F.round(F.col("o_custkey") / 1e6, 6).alias("p"), F.col("o_totalprice").alias("seconds"))
    # Rows of one key lie in one file, in order: the last one wins.
    rows.repartition("K", "p").sortWithinPartitions("K", "p", "seconds").write.option("header", True).csv(path)
    return Cat.read_timings(spark, path)


DAMAGE = """
    damaged AS (SELECT *, user_id % 11 AS harm FROM fragments),
    bad AS (SELECT * FROM (VALUES (1, 'errors', 'not a whole number'), (2, 'seconds', 'not a number'), (3, '', 'fields'), (4, 'custom_counts', 'not a counter map'),
        (5, 'custom_counts', 'not a counter map'), (6, 'json_metadata', 'not JSON'), (7, 'shots', 'missing'), (8, 'discards', 'negative')) t(harm, "column", reason))"""


def damaged_lines(spark, sf_dir):
    """Fragment lines with a header of seven or eight columns by batch, one of eight kinds of damage in most users' rows."""
    rows = fragments(table(spark, sf_dir, "events")).withColumn("kind", F.col("user_id") % 11).withColumn("batch_id", F.col("user_id") % 7)
    kind, short = F.col("kind"), F.col("batch_id") == 3
    text = {c: F.col(c).cast("string") for c in ("shots", "errors", "discards", "seconds", "decoder", "strong_id")}
    text["shots"] = F.when(kind == 7, "").otherwise(F.lpad("shots", 9, " "))
    text["errors"] = F.when(kind == 1, F.concat("errors", F.lit("x"))).otherwise(text["errors"])
    text["discards"] = F.when(kind == 8, "-1").otherwise(text["discards"])
    text["seconds"] = F.when(kind == 2, "abc").otherwise(text["seconds"])
    metadata = F.concat(F.lit('"'), F.replace("json_metadata", F.lit('"'), F.lit('""')), F.when(kind == 6, "}").otherwise(""), F.lit('"'))
    counts = F.when(kind == 4, '"{""k"":""x""}"').when(kind == 5, "[1]").otherwise('"{""k"":2}"')
    line = F.concat_ws(",", *text.values(), metadata)
    line = F.when(kind == 3, F.concat_ws(",", text["shots"], text["errors"], text["discards"])).when(short, line).otherwise(F.concat_ws(",", line, counts))
    return rows.select("batch_id", line.alias("line"), short.alias("short"))


@query(FRAG + "," + DAMAGE + """
    SELECT "column", reason, CAST(count(*) AS BIGINT) AS n FROM damaged JOIN bad USING (harm) WHERE NOT (harm IN (4, 5) AND user_id % 7 = 3) GROUP BY ALL
    UNION ALL
    SELECT 'shots', 'good', CAST(sum(shots) AS BIGINT) FROM damaged WHERE harm NOT IN (1, 2, 3, 4, 5, 6, 7, 8) OR (harm IN (4, 5) AND user_id % 7 = 3)""")
def malformed_reasons(spark, sf_dir):
    """Files with seven and eight columns in one folder, and why each damaged row was not taken; beside it the shots of the good ones."""
    root = new_path(spark, "damaged")
    lines = damaged_lines(spark, sf_dir)
    names = F.concat_ws(", ", *[F.lit(c) for c in STATS_COLUMNS[:-1]])
    head = lines.select("batch_id", F.when(F.col("short"), names).otherwise(F.concat(names, F.lit(",custom_counts"))).alias("line")).distinct()
    both = head.select("*", F.lit(0).alias("at")).unionByName(lines.select("batch_id", "line", F.lit(1).alias("at")))
    both.repartition("batch_id").sortWithinPartitions("batch_id", "at").select("batch_id", "line").write.partitionBy("batch_id").option("compression", "none").text(root)
    checked = K.read_checked(spark, root, "*.txt")
    reasons = K.malformed(checked).groupBy("column", "reason").agg(F.count("*").alias("n"))
    return reasons.unionByName(K.good(checked).agg(F.sum("shots").alias("n")).select(F.lit("shots").alias("column"), F.lit("good").alias("reason"), "n"))


@query(FRAG + "," + TOTALS_SQL + " SELECT strong_id, shots, errors, round(seconds, 4) AS seconds, CAST(0 AS BIGINT) AS local_files FROM totals")
def merge_mounted(spark, sf_dir):
    """S3: two folders mounted under one address of another file system, listed, read and merged by their new paths."""
    rows, mount = counter_rows(spark, sf_dir), "sweeps"
    for name, part in (("even", "batch_id % 2 = 0"), ("odd", "batch_id % 2 = 1")):
        folder = new_path(spark, f"mounted-{name}")
        rows.filter(part).select(*STATS_COLUMNS, "batch_id").write.partitionBy("batch_id").option("header", True).option("escape", '"').csv(folder)
        link = f"fs.viewfs.mounttable.{mount}.link./{name}"
        spark.conf.set(link, folder if ":" in folder else f"file://{folder}")  # for the readers of this session
        spark._jsc.hadoopConfiguration().set(link, spark.conf.get(link))  # for paths that are qualified outside of them
    root = f"viewfs://{mount}/"
    merged = M.merge_folder(spark, root, new_path(spark, "merged"))
    local = S.list_files(spark, root, "*.csv").filter(~F.startswith("path", F.lit(root))).agg(F.count("*").alias("local_files"))
    return merged.select("strong_id", "shots", "errors", F.round("seconds", 4).alias("seconds"), F.lit(local.first()[0]).cast("long").alias("local_files"))


@query("""
    SELECT p_brand, CAST(p_size AS BIGINT) AS p_size, CAST(count(*) AS BIGINT) AS n, CAST(1 AS BIGINT) AS n_files FROM (SELECT DISTINCT p_brand, p_size FROM part) GROUP BY ALL
    UNION ALL SELECT 'new', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS BIGINT)""")
def catalogue_compacted(spark, sf_dir):
    """A catalogue of small files packed into one indexed table, read by path; a second run packs nothing again."""
    root, out = part_files(spark, sf_dir), new_path(spark, "packed")
    Cat.compact(spark, root, "txt", out)
    again = Cat.compact(spark, root, "txt", out)
    packed = Cat.read_compacted(spark, out)
    fields = [F.replace(F.regexp_extract("path", p, 1), F.lit("%23"), F.lit("#")) for p in ("p_brand=([^/]+)/", "p_size=([^/]+)/")]
    n_files = F.lit(Cat.compacted_index(spark, out).count()).cast("long").alias("n_files")
    cells = packed.filter(F.startswith("text", F.lit("M 0"))).groupBy(fields[0].alias("p_brand"), fields[1].cast("long").alias("p_size")).agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("long")
    return cells.select("*", n_files).unionByName(cells.agg(F.lit("new").alias("p_brand"), zero.alias("p_size"), F.lit(again).cast("long").alias("n"), n_files))
