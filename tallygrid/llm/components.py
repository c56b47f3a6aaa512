"""Connected components of an edge table by alternating large-star and small-star steps.

Links stay in Spark; every step is a written table, so that lost executors cost a
re-read. A hub's neighbours are pre-aggregated before each shuffle and its join
side is one row, so that adaptive execution may split the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node points to one node, which points to none."""
    ends = edges.select("u", F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0), F.lit(1)).toDF("u", "out", "into"))
    nodes = ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.filter("out > 1 OR (out = 1 AND into = 1)").isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component) for every id that has a link; component is the smallest id reachable.

    Self links and repeated links change nothing; rows with a null end are ignored.
    """
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v").distinct()
    while True:
        now = materialize(_small_star(_large_star(now)), "stars")
        if _is_forest_of_stars(now):
            break
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
