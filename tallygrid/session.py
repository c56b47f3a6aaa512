"""Session defaults, the shared work folder, and checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only if it was measured and has at most this many rows and bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def build_session(app: str = "tallygrid", **conf: str) -> SparkSession:
    """A session with the settings the package is written for; `conf` overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which every executor can reach.

    Without that setting a local session works beside its tables, in the warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def _work_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tallygrid/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared folder, kept apart by application."""
    return f"{_work_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Delete what this application materialized; call it when no result is read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_work_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Later passes then see the same rows in any retry, and a lost executor costs
    a re-read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, derived: bool = False, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after a bounded look proved the side small, in rows and in bytes of its values as text.

    A larger side stays unhinted: Spark then uses a shuffled join, whose hot
    partitions adaptive execution splits. A `derived` side is written first, so
    that the count does not compute it a second time.
    """
    side = materialize(df, "side") if derived else df
    look = side.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in side.columns])))))
    n_rows, n_bytes = look.first()
    if n_rows <= max_rows and (n_bytes or 0) <= max_bytes:
        return F.broadcast(side)
    return side
