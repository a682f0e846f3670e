"""Screened clustering against the plain algorithm with every distance in Python integers."""

import hashlib

import numpy as np
import pytest

from asofmill.llm import clustering
from asofmill.llm.integer_vectors import most_component

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, k, rounds, width, scale=256):
    """(vec_id, cluster, distance, cluster_inertia, inertia, hash) of the rows (id, vector), sorted."""
    kept = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(i, q) for i, q in kept if max(map(abs, q)) <= most_component(width)]
    centroids = [q for _, q in sorted(((hashlib.sha256(f"2:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None))[:k]]
    if not centroids:
        return []

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = {}
        for _, q in kept:
            own.setdefault(nearest(q)[1], []).append(q)
        centroids = [[sum(x) // len(own[j]) for x in zip(*own[j], strict=True)] if j in own else c for j, c in enumerate(centroids)]
    last = [(i, *nearest(q)[::-1]) for i, q in kept]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = {j: sum(d for _, c, d in last if c == j) for _, j, _ in last}
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), names[j]) for i, j, d in last), key=repr)


def answer(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_against_every_distance(spark, spread):
    random = np.random.default_rng(1)
    centres = random.standard_normal((8, 10))
    rows = [(i, (centres[i % 8] + spread * random.standard_normal(10)).tolist()) for i in range(500)]
    got = clustering.cluster(frame(spark, rows), k=12, rounds=4, width=10)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert answer(got) == brute(rows, 12, 4, 10)


def test_ties_copies_and_odd_rows(spark):
    ties = [(i, [float(i % 3), 0.0, float(i % 2), 1.0]) for i in range(60)]
    odd = [(100, None), (101, [1.0, 2.0]), (102, [1.0, None, 1.0, 1.0]), (103, [float("nan"), 1.0, 1.0, 1.0]), (104, [float("inf"), 1.0, 1.0, 1.0]), (105, [1e300, 0.0, 0.0, 0.0])]
    more = [(None, [2.0, 2.0, 2.0, 2.0]), (7, [5.0, 5.0, 5.0, 5.0]), (7, [5.0, 5.0, 5.0, 5.0]), (-3, [-0.001, 0.0, 0.0, 0.0])]
    rows = ties + odd + more
    assert answer(clustering.cluster(frame(spark, rows), k=9, rounds=3, width=4)) == brute(rows, 9, 3, 4)
    assert answer(clustering.cluster(frame(spark, rows), k=9, rounds=3)) == brute(rows, 9, 3, 4)  # the most frequent width


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, [1.0, 2.0])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [9.0, 9.0])]])
def test_few_rows(spark, rows):
    assert answer(clustering.cluster(frame(spark, rows), k=5, rounds=2, width=2)) == brute(rows, 5, 2, 2)


def test_large_components_and_inertia_beyond_a_long(spark):
    x = most_component(2) / 256
    rows = [(i, [x * (-1) ** i, x]) for i in range(20)]
    got = clustering.cluster(frame(spark, rows), k=1, rounds=1, width=2).collect()
    want = brute(rows, 1, 1, 2)
    assert {r.distance for r in got} == {d for _, _, d, *_ in want}
    assert {r.inertia for r in got} == {w[4] if w[4] < 1 << 63 else None for w in want}


def test_screening_skips_most_distances_of_clustered_vectors():
    random = np.random.default_rng(2)
    centres = random.integers(-400, 400, (40, 64))
    q = centres[np.arange(4000) % 40] + random.integers(-20, 20, (4000, 64))
    nearest, far, exact = clustering.assign(q, clustering.segment_norms(q), centres)
    every = ((q[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (nearest == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    assert exact < 0.1 * every.size


def test_bounds_hold_where_rounding_matters():
    most = most_component(8)
    q = np.array([[most] * 8, [most - 1] * 8, [0] * 8, [1, 0, 0, 0, 0, 0, 0, 0]])
    c = np.array([[most - 1] * 8, [most] * 8, [0] * 8])
    nearest, far, _ = clustering.assign(q, clustering.segment_norms(q), c)
    assert nearest.tolist() == [1, 0, 2, 2] and far.tolist() == [0, 0, 0, 1]
