"""Collection with user samplers: tasks in, counters out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.operators import checks
from tallygrid.operators.combine import combine, combine_with_counters, counts_as_map, union_fragments
from tallygrid.operators.ordered import join_groups
from tallygrid.operators.progress import remaining_work
from tallygrid.operators.shots import CHECKED, EVENTS, classify_shots, shot_counters, with_tasks
from tallygrid.schema import STATS, STATS_COLUMNS
from tallygrid.session import materialize
from tallygrid.sinks.stats import counts_as_json

if TYPE_CHECKING:
    import pandas as pd

    Sampler = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def collect(tasks: DataFrame, samplers: dict[str, Sampler], parallelism: int | None = None) -> DataFrame:
    """Counter rows of all tasks, each sampled by the function registered under its `decoder`.

    A sampler maps batches of task rows (with `remaining_shots`, `remaining_errors`)
    to counter rows. `parallelism` spreads the tasks, since a row is small but its
    work is not. The rows are written once, so that no later use samples again.
    """
    tasks = materialize(tasks, "tasks")  # looked at once for the check and once by each sampler
    known = F.coalesce(F.col("decoder").isin(list(samplers)), F.lit(False))
    unknown = tasks.filter(~known).select("decoder").first()
    if unknown is not None:
        raise ValueError(f"no sampler is registered as {unknown.decoder!r}; known: {sorted(samplers)}")
    spread = tasks.repartition(parallelism) if parallelism else tasks
    sampled = [spread.filter(F.col("decoder") == name).mapInPandas(fn, STATS) for name, fn in samplers.items()]
    return materialize(reduce(DataFrame.unionByName, sampled), "sampled")


def collect_shots(shots: DataFrame, tasks: DataFrame) -> DataFrame:
    """Counter records of shots that exist as a table, with the columns of stats files.

    `tasks` gives each shot its id, decoder, masks and, if it has them, metadata; the
    named counters hold the events and error patterns. `seconds` is the sum of the
    shots' own, 0 if they have none. Counts of checked detectors and events follow
    the record's columns. A shot of an unknown task stays, under a NULL decoder.
    """
    rows = with_tasks(shots, tasks)
    rows = rows if "json_metadata" in rows.columns else rows.withColumn("json_metadata", F.lit(None).cast("string"))
    rows = rows if "seconds" in rows.columns else rows.withColumn("seconds", F.lit(0.0))
    keys = ["task_id", "decoder", "json_metadata"]
    counted = classify_shots(rows, keys)
    seconds = rows.groupBy(*keys).agg(F.sum("seconds").alias("seconds"))
    named = shot_counters(rows, keys).groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("counter", "n")))).alias("custom_counts"))
    joined = join_groups(join_groups(counted, seconds, keys), named, keys, "left").withColumnRenamed("task_id", "strong_id")
    return counts_as_json(joined).select(*STATS_COLUMNS, CHECKED, EVENTS)


def resume(tasks: DataFrame, totals: DataFrame, samplers: dict[str, Sampler], parallelism: int | None = None) -> DataFrame:
    """Sample what the counters on disk leave open, and return old and new totals together.

    `totals` may be fragments with JSON counters or merged rows with a counter map;
    the named counters are added up like the others. A task without a limit on its
    shots is open until its errors reach theirs.
    """
    open_tasks = remaining_work(tasks, combine(totals)).filter("end_reason IS NULL")
    new = collect(open_tasks, samplers, parallelism)
    old = totals.select(*[c for c in totals.columns if c in STATS_COLUMNS])
    return combine_with_counters(union_fragments([counts_as_map(old), counts_as_map(new)], aggregate=False))


def invalid_counters(stats: DataFrame, budget: int) -> DataFrame:
    """Counter rows outside their ranges."""
    return checks.violations(stats, ["strong_id"], checks.stats_rules(budget))
