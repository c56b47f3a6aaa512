"""Small DataFrame helpers of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that the frame does not use, whatever its columns are called."""
    taken, out = {c.lower() for c in df.columns}, []
    for base in bases:
        name = f"_{base}"
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def keep_ids(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The documents whose doc_id is (`left_semi`) or is not (`left_anti`) in `ids`; null equals null."""
    (key,) = fresh(docs, "keep")
    side = ids.select(F.col("doc_id").alias(key)).distinct()
    return docs.join(side, docs["doc_id"].eqNullSafe(side[key]), how)


# Rows of an Arrow batch between Spark and Python: texts can be long, and a worker holds a batch whole.
BATCH_ROWS = 512


def small_batches(df: DataFrame) -> None:
    """Set the session's Arrow batches to a few hundred rows, unless the user has set a number."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, str(BATCH_ROWS))
