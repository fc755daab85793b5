"""Centroid clustering against plain whole-number rounds."""

import hashlib
import math

import numpy as np
import pytest

from millrace.llm import centroids
from millrace.llm.common import table
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def by_hand(rows, width=64, count=40, rounds=5):
    kept = [
        (i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    centres = [v for _, v in start[:count]]

    def assign():
        found = []
        for _, v in kept:
            distances = [sum((x - y) ** 2 for x, y in zip(v, c)) for c in centres]
            found.append((distances.index(min(distances)), min(distances)))
        return found

    for _ in range(rounds):
        own = assign()
        for c in range(len(centres)):
            members = [v for (_, v), (k, _) in zip(kept, own) if k == c]
            if members:
                centres[c] = [sum(x) // len(members) for x in zip(*members)]
    own = assign()
    total = sum(d for _, d in own)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, c, d, sum(e for k, e in own if k == c), total, names[c]) for (i, _), (c, d) in zip(kept, own)]


def same(df, rows, **options):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(by_hand(rows, **options), key=key)


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    same(QUERIES["op13_centroids"](spark, SF), rows)


def test_odd_vectors_ties_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 3, 4) / 256]) for i in range(300)]
    rows += rows[:40] + [(1000, None), (1001, [1.0] * 3), (1002, [1.0, None, 2.0, 3.0]), (1003, [1.0, math.nan, 2.0, 3.0])]
    rows += [(1004, [1.0, math.inf, 2.0, 3.0]), (None, [0.5] * 4), (1005, []), (1006, [30000.0, -30000.0, 0.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, cluster string")
    for pivots in (1, 2, 16):
        same(centroids.cluster(df, width=4, pivots=pivots, centroids=7), rows, width=4, count=7)
    same(centroids.cluster(df.limit(3), width=4), [tuple(r)[:2] for r in df.limit(3).collect()], width=4)
    assert centroids.cluster(df.limit(0), width=4).count() == 0
    assert centroids.cluster(df.limit(0)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    equal = spark.createDataFrame([(i, [0.25] * 4) for i in range(50)], "vec_id bigint, embedding array<double>")
    assert {(r.cluster, r.distance, r.inertia) for r in centroids.cluster(equal, width=4, centroids=5).collect()} == {(0, 0, 0)}
    huge = spark.createDataFrame([(1, [1e30] * 4)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(huge, width=4).collect()


def test_bounds_hold_and_leave_centroids_out(spark):
    rows = np.array([r.embedding for r in table(spark, "/root/testdata/sf0.01", "embeddings").collect()], dtype=np.float64)
    v = np.floor(256 * rows).astype(np.int64)
    simplex = centroids.Simplex(centroids.far_apart(v[:200], 16))
    low, high = centroids.bounds(simplex.apexes(v), simplex.apexes(v[:40]))
    exact = centroids.squared(v, v[:40])
    assert (low <= exact).all() and (exact <= high).all()
    cluster, distance, computed = centroids.nearest(v, simplex.apexes(v), v[:40], simplex.apexes(v[:40]))
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert len(v) <= computed < exact.size
    # tight groups: nearly all other centroids are left out
    rng = np.random.default_rng(1)
    middles = rng.integers(-5000, 5000, (10, 64))
    points = np.repeat(middles, 50, axis=0) + rng.integers(-5, 6, (500, 64))
    simplex = centroids.Simplex(centroids.far_apart(points, 16))
    assert centroids.nearest(points, simplex.apexes(points), middles, simplex.apexes(middles))[2] < 600
    large = rng.integers(-(1 << 27), 1 << 27, (20, 64))
    assert (centroids.squared(large, large) == [[sum((int(x) - int(y)) ** 2 for x, y in zip(a, b)) for b in large] for a in large]).all()
