"""Sort-means against k-means that computes every distance, with odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import sortmeans

SCHEMA = "vec_id long, embedding array<float>, cluster int, v int, distance long, h string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], SCHEMA)


def brute(rows, dim, k, rounds):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(ok, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    centroids = [v for _, v in first]
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min((d(v, c), n) for n, c in enumerate(centroids)) for _, v in ok]
    for _ in range(rounds):
        best = assign()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(ok, best) if c == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    best = assign()
    inertia = [sum(x for x, c in best if c == n) for n in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, x, inertia[c], sum(inertia), sha[c]) for (i, _), (x, c) in zip(ok, best)]


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


def case(dim):
    rng = random.Random(9)
    middle = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in middle[i % 5]]) for i in range(150)]
    rows += [(200 + i, [rng.randint(-1, 1) / 256 for _ in range(dim)]) for i in range(60)]  # many ties
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (None, rows[5][1])] + [(400 + k, rows[7][1]) for k in range(80)]
    rows += [(500, None), (501, []), (502, [1.0] * (dim - 1)), (503, [1.0] * (dim + 1)), (504, [None] + [0.0] * (dim - 1)), (505, [float("nan")] + [0.0] * (dim - 1)), (506, [float("inf")] + [0.0] * (dim - 1))]
    return rows + [(507, [90000.5] * dim), (508, [-90000.5] * dim)]


@pytest.mark.parametrize("dim, k, rounds", [(4, 12, 5), (64, 40, 2)])
def test_equals_all_distances(spark, dim, k, rounds):
    rows = case(dim)
    got = sortmeans.cluster(vectors_of(spark, rows), dim=dim, k=k, rounds=rounds)
    assert by_text(got.collect()) == by_text(brute(rows, dim, k, rounds))


def test_few_vectors_none_and_too_large(spark):
    rows = [(5, [0.5, 0.5]), (6, [0.5, 0.5]), (7, [-1.0, 2.0])]
    assert by_text(sortmeans.cluster(vectors_of(spark, rows), dim=2).collect()) == by_text(brute(rows, 2, 40, 5))
    none = sortmeans.cluster(vectors_of(spark, [(1, None)]), dim=2)
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match="don't fit a long"):
        sortmeans.cluster(vectors_of(spark, [(1, [3e38, 0.0])]), dim=2).count()


def test_scans_stop_early_and_lose_no_tie():
    rng = np.random.default_rng(3)
    centroids = rng.integers(-500, 500, (40, 8))
    x = centroids[rng.integers(0, 40, 5000)] + rng.integers(-30, 30, (5000, 8))
    every = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    best, found, made = sortmeans.nearest(x, every.argmin(axis=1), centroids)
    assert (best == every.argmin(axis=1)).all() and (found == every.min(axis=1)).all()
    assert made < 5000 * 4  # of 40
    # A row in the middle between two centroids scans the other one, which is at twice its distance exactly.
    pair = np.array([[10, 0], [0, 0], [20, 0]])
    best, found, _ = sortmeans.nearest(np.array([[10, 0], [5, 0], [15, 0]]), np.array([2, 0, 2]), pair)
    assert best.tolist() == [0, 0, 0] and found.tolist() == [0, 25, 25]
    best, _, _ = sortmeans.nearest(np.array([[5, 0]]), np.array([1]), pair)
    assert best.tolist() == [0]
