import hashlib
import random

import numpy as np
import pytest

from tallygrid.llm.centroids import cluster, first_centroids, quantised, with_inertia


def plain(rows, k, rounds, scale):
    """Full distances of every vector in every round."""
    kept = [(i, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v]) for i, v in rows if v is not None and len(v) == 3 and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)[0]].append(v)
        centroids = [[sum(col) // len(m) for col in zip(*m)] if m else c for m, c in zip(members, centroids)]
    return [(i, *nearest(v)) for i, v in kept], centroids


@pytest.fixture
def vectors(spark):
    def make(rows):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        return frame.selectExpr("*", "1 AS x", "2 AS dots", "3 AS cluster", "4 AS distance", "5 AS n", "6 AS rank")

    return make


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


@pytest.mark.parametrize("k, rounds", [(1, 0), (4, 3), (7, 2), (50, 3)])
def test_same_as_full_distances(spark, vectors, k, rounds):
    rng = random.Random(k)
    rows = [(i, [rng.choice([rng.gauss(0, 2), 0.5, -0.25]) for _ in range(3)]) for i in range(40)]
    rows += rows[:5] + [(None, [0.5, 0.5, 0.5]), (None, [0.5, 0.5, 0.5])]
    rows += [(90, None), (91, []), (92, [1.0, 2.0]), (93, [1.0, None, 2.0]), (94, [float("nan"), 1.0, 1.0]), (95, [float("inf"), 1.0, 1.0]), (96, [1.0] * 4)]
    assigned, centroids = cluster(vectors(rows).repartition(5), k=k, rounds=rounds, components=3)
    want, means = plain(rows, k, rounds, 64)
    assert centroids.tolist() == means
    out = with_inertia(assigned, centroids).collect()
    assert order((r.vec_id, r.cluster, r.distance) for r in out) == order(want)
    sums = {c: sum(d for _, e, d in want if e == c) for _, c, _ in want}
    for r in out:
        assert r.cluster_inertia == sums[r.cluster] and r.inertia == sum(sums.values())
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, means[r.cluster])).encode()).hexdigest()


def test_ties_go_to_the_smaller_number(vectors):
    rows = [(i, [1.0, 1.0, 1.0]) for i in range(6)]
    assigned, centroids = cluster(vectors(rows), k=3, rounds=2, components=3)
    assert {(r.cluster, r.distance) for r in assigned.collect()} == {(0, 0)} and len(centroids) == 3


def test_no_vectors(vectors):
    out = with_inertia(*cluster(vectors([(1, None), (2, [1.0])])))
    assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert with_inertia(*cluster(vectors([]))).collect() == []


def test_exact_at_the_largest_components(vectors):
    rows = [(i, [(-1) ** i * 2097152.0, 2097151.75, -2097152.0]) for i in range(9)]
    assigned, _ = cluster(vectors(rows), k=2, rounds=3, components=3)
    assert order((r.vec_id, r.cluster, r.distance) for r in assigned.collect()) == order(plain(rows, 2, 3, 64)[0])


def test_larger_components_are_refused(vectors):
    with pytest.raises(Exception, match="beyond"):
        first_centroids(quantised(vectors([(1, [1e30, 0.0, 0.0])]), components=3))
