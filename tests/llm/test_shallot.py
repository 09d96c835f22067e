"""Clusters against measuring every vector with every centroid."""

import hashlib
import math
import random

import numpy as np
import pytest

from casebook.llm import shallot

SCHEMA = "vec_id long, embedding array<double>"


def brute_clusters(rows, k, rounds, dimension):
    kept = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i8").tobytes())
    centres = [v for _, v in sorted(kept, key=key)[:k]]
    way = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    nearest = lambda v: min(range(len(centres)), key=lambda c: (way(v, centres[c]), c))
    for _ in range(rounds):
        own = [nearest(v) for _, v in kept]
        for c in set(own):
            members = [v for (_, v), o in zip(kept, own) if o == c]
            centres[c] = [sum(column) // len(members) for column in zip(*members)]
    last = [nearest(v) for _, v in kept]
    way_of = [way(v, centres[c]) for (_, v), c in zip(kept, last)]
    long = lambda x: x if x < 1 << 63 else None
    return sorted(
        (
            (i, c, long(d), long(sum(e for e, o in zip(way_of, last) if o == c)), long(sum(way_of)),
             hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
            for (i, _), c, d in zip(kept, last, way_of)
        ),
        key=str,
    )


def clustered(spark, rows, **settings):
    made = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, shallot.cluster_vectors(made, **settings).drop("centroid").collect()), key=str)


@pytest.mark.parametrize("seed, k, dimension, spread", [(1, 5, 3, 1.0), (2, 16, 8, 4.0), (3, 40, 2, 0.05)])
def test_equals_brute_force_with_ties_and_copies(spark, seed, k, dimension, spread):
    rng = random.Random(seed)
    middles = [[rng.uniform(-spread, spread) for _ in range(dimension)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(middles)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [rows[1]] * 5  # a third are copies of one vector
    assert clustered(spark, rows, k=k, rounds=3, dimension=dimension) == brute_clusters(rows, k, 3, dimension)


def test_nulls_lengths_and_extreme_values(spark):
    rows = [
        (1, [0.5, 0.25]), (2, [-0.51, 0.0]), (None, [0.5, 0.5]), (4, None), (5, []), (6, [1.0]), (7, [1.0, None]),
        (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [3e9, -3e9]), (11, [-0.0, 1e-300]),
    ]
    found = clustered(spark, rows, k=3, rounds=2, dimension=2)
    assert found == brute_clusters(rows, 3, 2, 2)
    assert {r[0] for r in found} == {1, 2, None, 10, 11}


def test_fewer_vectors_than_centroids_one_centroid_and_none(spark):
    rows = [(i, [float(i), 0.0]) for i in range(4)]
    assert clustered(spark, rows, k=16, rounds=3, dimension=2) == brute_clusters(rows, 16, 3, 2)
    assert clustered(spark, rows, k=1, rounds=3, dimension=2) == brute_clusters(rows, 1, 3, 2)
    assert clustered(spark, [], k=3, rounds=3, dimension=2) == []


def test_other_columns_and_floats(spark):
    rows = [(i, [i / 7, -i / 3]) for i in range(50)]
    made = spark.createDataFrame([(i, [float(np.float32(x)) for x in v], 3, "x") for i, v in rows], "vec_id int, embedding array<float>, cluster int, near string")
    found = sorted(map(tuple, shallot.cluster_vectors(made, 4, 3, 2).drop("centroid").collect()), key=str)
    assert found == brute_clusters([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 4, 3, 2)


def test_bounds_spare_measurements():
    """Far fewer distances than all against all, round by round, and the same state as a full scan."""
    rng = np.random.default_rng(4)
    middles = rng.integers(-4000, 4000, (64, 16))
    vectors = (middles[rng.integers(0, 64, 5000)] + rng.integers(-60, 60, (5000, 16))).astype(np.int64)
    centres = vectors[rng.choice(5000, 64, replace=False)]
    near, second = np.zeros(5000, np.int32), np.ones(5000, np.int32)
    upper, lower = np.full(5000, np.inf), np.zeros(5000)
    moved = np.zeros(64)
    shares = []
    for _ in range(6):
        search = shallot.Search(shallot.Centroids(centres.tolist(), moved.tolist()))
        search.assign(vectors, near, second, upper, lower)
        full = ((vectors[:, None] - centres[None]) ** 2).sum(axis=2)
        assert (near == full.argmin(axis=1)).all()
        shares.append(search.measured / full.size)
        new = np.array([vectors[near == c].sum(axis=0) // max(1, (near == c).sum()) if (near == c).any() else centres[c] for c in range(64)])
        moved = np.sqrt(((new - centres) ** 2).sum(axis=1).astype(float)) * (1 + shallot.SLACK)
        centres = new
    assert shares[0] < 0.9 and shares[1] < 0.5 and max(shares[3:]) < 0.01
