from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm.simplex_clusters import cluster, possible, simplex_of, squared_distances

NAN, INF = float("nan"), float("inf")


def plain(rows, width, clusters, rounds, seed=3, scale=1024):
    """Lloyd's rounds, one vector at a time, in Python's whole numbers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == width
            and all(x is not None and math.isfinite(x) for x in v)]
    seeded = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in seeded[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m, strict=True)] if m else c for m, c in zip(members, centroids, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept] if centroids else []
    total = [sum(d for _, d, n in found if n == k) for k in range(len(centroids))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, total[n], sum(total), shas[n]) for i, d, n in found), key=str)


def found_rows(spark, rows, **settings):
    frame = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, cluster STRING, apex INT")
    found = cluster(frame.repartition(3), **settings)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"]
    return sorted((tuple(r)[:-1] for r in found.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_as_one_vector_at_a_time(spark, seed):
    chance = random.Random(seed)
    centres = [[chance.gauss(0, 1) for _ in range(5)] for _ in range(4)]
    rows = [(i, [x + chance.gauss(0, 0.3) for x in chance.choice(centres)]) for i in range(300)]
    rows += [(300, None), (301, [1.0]), (302, [NAN] * 5), (303, [INF, 0.0, 0.0, 0.0, 0.0]), (304, [None, 0.0, 0.0, 0.0, 0.0])]
    rows += [(None, [0.5] * 5), (7, rows[9][1]), (7, rows[7][1])]
    settings = {"width": 5, "clusters": 6, "rounds": 4}
    assert found_rows(spark, rows, **settings) == plain(rows, **settings)


def test_ties_equal_vectors_and_empty_centroids(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(40)]  # two places, so most centroids stay empty
    settings = {"width": 2, "clusters": 5, "rounds": 3}
    assert found_rows(spark, rows, **settings) == plain(rows, **settings)
    few = [(1, [0.25, -0.25]), (2, [0.1, 0.2])]
    assert found_rows(spark, few, **settings) == plain(few, **settings)


def test_large_components_are_exact(spark):
    rows = [(i, [1e5 * i, -2e5, 3.0]) for i in range(20)] + [(20, [4e5, 1e6, 0.0])]
    settings = {"width": 3, "clusters": 3, "rounds": 2}
    assert found_rows(spark, rows, **settings) == plain(rows, **settings)
    wide = cluster(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0])], "vec_id INT, embedding ARRAY<DOUBLE>"), width=2, clusters=1, rounds=1)
    assert {r.distance for r in wide.collect()} == {None} and {r.inertia for r in wide.collect()} == {None}


def test_empty_tables_and_no_ids(spark):
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    assert cluster(spark.createDataFrame([], schema), width=2).collect() == []
    assert cluster(spark.createDataFrame([(None, [1.0, 2.0])], schema), width=2).collect() == []


def test_bounds_hold_and_rule_out_most():
    random_ = np.random.default_rng(5)
    centres = random_.normal(size=(8, 64)) * 200
    vectors = (centres[random_.integers(0, 8, 500)] + random_.normal(size=(500, 64)) * 40).astype(np.int64)
    for some in (vectors, np.repeat(vectors[:3], 100, axis=0), np.outer(np.arange(300), np.ones(64, int))):
        simplex = simplex_of(some[:64])
        apexes = simplex.apexes(squared_distances(some, simplex.pivots))
        centroids = some[::37][:8] + 1
        corners = simplex.apexes(squared_distances(centroids, simplex.pivots))
        exact = squared_distances(some, centroids)
        low = ((apexes[:, None, :] - corners[None, :, :]) ** 2).sum(axis=2)
        turned = corners * np.append(np.ones(corners.shape[1] - 1), -1)
        high = ((apexes[:, None, :] - turned[None, :, :]) ** 2).sum(axis=2)
        slack = 1e-7 * exact + 1
        assert (low <= exact + slack).all() and (exact <= high + slack).all()
        open_ = possible(apexes, corners)
        assert open_[np.arange(len(some)), exact.argmin(axis=1)].all()
    simplex = simplex_of(vectors[:64])
    open_ = possible(*[simplex.apexes(squared_distances(v, simplex.pivots)) for v in (vectors, centres)])
    assert open_.mean() < 0.3
