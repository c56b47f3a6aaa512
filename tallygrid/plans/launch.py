"""Plan a sweep: catalogue to batch folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.functions import names
from tallygrid.operators import balance as B
from tallygrid.session import materialize
from tallygrid.sinks.stats import write_batches
from tallygrid.sources.catalogue import read_catalogue, split_by_name


def plan_by_count(spark: SparkSession, root: str, extension: str, out: str, per_batch: int | None = None, batches: int | None = None, run_id: str | None = None, prefix: str = "") -> DataFrame:
    """Round-robin batches of the catalogue; returns the batch sizes.

    Paths are ordered folder by folder (`a/x` before `a-b/x`). Only the paths are
    sorted and numbered; the texts meet their batch in a join.
    """
    catalogue = read_catalogue(spark, root, extension)
    assigned = materialize(B.round_robin(catalogue.select("path"), [F.split("path", "/")], per_batch, batches), "assigned")
    write_batches(catalogue.join(assigned, "path"), out, run_id, prefix=prefix)
    return B.batch_sizes(assigned)


def with_grid_keys(catalogue: DataFrame) -> DataFrame:
    """Typed `K` and `p` from `family_K=<int>_p=<float>` names; a bad name is an error."""
    good, bad = split_by_name(catalogue, names.parse_underscore_name, ["K", "p"])
    typed = good.select("*", names.meta_value("meta", "K", "int").alias("K"), names.meta_value("meta", "p", "double").alias("p"))
    broken = bad.select("path").unionByName(typed.filter("K is null or p is null").select("path"))
    first = broken.first()
    if first is not None:
        raise ValueError(f"no K and p in the name of {broken.count()} files, such as {first.path}")
    return typed


def p_key(p: str) -> Column:
    """A rate as a decimal: rates that were computed on different ways meet at twelve places."""
    return F.col(p).cast("decimal(20,12)")


def assign_by_cost(catalogue: DataFrame, timings: DataFrame, batches: int) -> DataFrame:
    """Longest-first batches of a catalogue with `K` and `p`; each experiment needs a timing."""
    keyed, seconds = catalogue.withColumn("_p", p_key("p")), timings.select("K", p_key("p").alias("_p"), "seconds")
    B.missing_timings(keyed, seconds, ["K", "_p"], strict=True)
    timed = B.with_timings(keyed, seconds, ["K", "_p"]).select(*catalogue.columns, "seconds")
    return B.longest_first(timed, "seconds", [F.split("path", "/")], batches)


def plan_by_cost(spark: SparkSession, root: str, extension: str, timings: DataFrame, batches: int, out: str, run_id: str | None = None, prefix: str = "") -> DataFrame:
    """Cost-balanced batch folders; returns the load of every batch."""
    catalogue = with_grid_keys(read_catalogue(spark, root, extension, recursive=False))
    assigned = assign_by_cost(catalogue, timings, batches)
    write_batches(assigned.drop("meta"), out, run_id, prefix=prefix)
    return B.batch_loads(assigned.withColumn("_all", F.lit(0)), "seconds", batches, ["_all"]).drop("_all")
