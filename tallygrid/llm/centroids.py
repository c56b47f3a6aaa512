"""Centroid clustering (Lloyd's rounds) over an incremental matrix of exact dot products.

Vectors are turned into integers, and for every vector the integer dot product with
each centroid is kept in a written table. When a centroid moves, the products change
by the dot product with its change, and only the components that did change are
multiplied. Squared distance is |x|^2 - 2 x.c + |c|^2, so an assignment is an addition
and an argmin, exact at any round. All centroids start from zero, where the products
are zero, so the first pass is an update like the others.

A pass reads and writes each vector once and shuffles nothing. The sums of a round
are folded in the tasks: k x d numbers of each reach the shuffle, and k x d the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.session import materialize

CENTROIDS, ROUNDS, COMPONENTS, SCALE = 16, 3, 64, 64
# Components beyond this could take a squared distance past 64 bits.
LARGEST = 1 << 27


def whole_vectors(column: str = "embedding", components: int = COMPONENTS) -> Column:
    """Whether a vector has all its components, none of them null, NaN or infinite."""
    finite = F.forall(column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(column) == components) & finite, F.lit(False))


def quantised(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and x, the integers floor(scale * component), of the whole vectors; an error where one is beyond LARGEST."""
    value = F.transform(column, lambda x: F.floor(x.cast("double") * scale))
    small = F.forall("x", lambda x: F.abs(x) <= LARGEST)
    kept = vectors.filter(whole_vectors(column, components)).select("vec_id", value.alias("x"))
    return kept.select("vec_id", F.when(small, F.col("x").cast("array<int>")).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST}"))).alias("x"))


def first_centroids(points: DataFrame, k: int = CENTROIDS, seed: str = "1") -> np.ndarray:
    """The k vectors with the smallest sha256 of `<seed>:<vec_id>`; a null id reads `null`, rows that repeat an id go by components."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    rows = points.select(rank.alias("rank"), "x").orderBy("rank", "x").limit(k).collect()
    return np.array([r.x for r in rows], np.int64)


def _matrix(lists: pa.Array, n: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


_TABLE = "vec_id long, x array<int>, dots array<long>, cluster int, distance long"


def _update(centroids: np.ndarray, change: np.ndarray):
    """Products moved on by the change of each centroid, and the nearest centroid (the smaller number of equals)."""
    norms = (centroids * centroids).sum(axis=1)
    moved = [np.flatnonzero(row) for row in change]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("x"), n)
            if "dots" in batch.schema.names:
                dots = _matrix(batch.column("dots"), n)
            else:
                dots = np.zeros((n, len(centroids)), np.int64)
            for c, at in enumerate(moved):
                if len(at):
                    dots[:, c] += x[:, at] @ change[c, at]
            far = norms - 2 * dots  # |x|^2 is the same for all centroids
            nearest = far.argmin(axis=1)
            distance = far[np.arange(n), nearest] + (x * x).sum(axis=1)
            ends = pa.array(np.arange(0, (n + 1) * len(centroids), len(centroids), dtype=np.int32))
            products = pa.ListArray.from_arrays(ends, pa.array(dots.ravel()))
            columns = [batch.column("vec_id"), batch.column("x"), products, pa.array(nearest.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "x", "dots", "cluster", "distance"])

    return run


def _sums(k: int, d: int):
    """Vectors and component sums of each cluster, one row for each cluster a task has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many, total = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, cluster = _matrix(batch.column("x"), batch.num_rows), batch.column("cluster").to_numpy()
            order = np.argsort(cluster, kind="stable")
            first = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            found = cluster[order][first]
            total[found] += np.add.reduceat(x[order], first, axis=0)
            many += np.bincount(cluster, minlength=k)
        seen = np.flatnonzero(many)
        ends = pa.array(np.arange(0, (len(seen) + 1) * d, d, dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(many[seen]), pa.ListArray.from_arrays(ends, pa.array(total[seen].ravel()))], ["cluster", "n", "total"]
        )

    return run


def _means(assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The exact floor of each cluster's mean; a centroid without vectors stays."""
    k, d = centroids.shape
    folded = assigned.select("cluster", "x").mapInArrow(_sums(k, d), "cluster int, n long, total array<long>")
    rows = folded.select("cluster", "n", F.posexplode("total").alias("j", "s")).groupBy("cluster", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out = centroids.copy()
    for r in rows.collect():  # k x d numbers
        out[r.cluster, r.j] = r.s // r.n
    return out


def cluster(
    vectors: DataFrame, column: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE, seed: str = "1"
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every whole vector after `rounds` moves of the centroids, and the final centroids.

    Vectors of another length and those with a null or non-finite component have no
    row. Rows that repeat count each time, a null vec_id is kept, ties go to the smaller
    number, other columns are ignored. With fewer than k vectors there are as many
    centroids as vectors, and without vectors no rows. Components larger than
    LARGEST are an error, as 64 bits would not hold their distances. Runs jobs; the
    products of each round are a written table, and a lost executor costs a re-read of it.
    """
    points = quantised(vectors, column, components, scale)
    centroids = first_centroids(points, k, seed)
    if not len(centroids):
        return points.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    before, table = np.zeros_like(centroids), points
    for turn in range(rounds + 1):
        table = materialize(table.mapInArrow(_update(centroids, centroids - before), _TABLE), f"products-{turn}")
        if turn < rounds:
            before, centroids = centroids, _means(table, centroids)
    return table.select("vec_id", "cluster", "distance"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows of `cluster` with the distance summed over their cluster and over all, and the digest of their final centroid."""
    k = len(centroids)
    if not k:
        return assigned.select("*", *[F.lit(None).cast("long").alias(c) for c in ("cluster_inertia", "inertia")], F.lit(None).cast("string").alias("centroid_sha256"))
    sums = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest() for row in centroids]
    own = [F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster")) for values, kind in (([sums.get(c, 0) for c in range(k)], "long"), (digests, "string"))]
    return assigned.select("*", own[0].alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"), own[1].alias("centroid_sha256"))
