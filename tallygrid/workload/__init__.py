"""The registered queries: every operator on the given tables, beside the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its function name."""

    def register(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


from tallygrid.workload import backends, batches, bits, counters, files, names, streams  # noqa: E402,F401
