"""Clustering with ns-bounds against all distances in plain integers."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fleetworks.llm import centroids

DIMS = 6
SCHEMA = "vec_id bigint, embedding array<float>, cluster string, `a.b` string"


def brute(rows, k, rounds, scale=256, dims=DIMS):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [list(v) for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        placed = [nearest(v)[1] for _, v in kept]
        for n in range(len(centres)):
            own = [v for (_, v), p in zip(kept, placed) if p == n]
            if own:
                centres[n] = [sum(x) // len(own) for x in zip(*own)]
    found = [nearest(v) for _, v in kept]
    inertia = Counter()
    for d, n in found:
        inertia[n] += d
    return Counter((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest())
                   for (i, _), (d, n) in zip(kept, found))


def rows_of(seed, n, spread=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, spread) for _ in range(DIMS)] for _ in range(7)]
    return [(i, [rng.gauss(m, 0.3) for m in rng.choice(middles)]) for i in range(n)]


def got(frame):
    return Counter(tuple(r) for r in frame.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())


def clustered(spark, rows, k, rounds):
    table = spark.createDataFrame([(i, v, "clash", "dot") for i, v in rows], SCHEMA)
    return got(centroids.cluster(table.repartition(3), clusters=k, rounds=rounds, dims=DIMS))


@pytest.mark.parametrize("seed, n, k, rounds", [(1, 400, 12, 5), (2, 300, 25, 8), (3, 30, 40, 3), (4, 200, 1, 2), (5, 150, 11, 0)])
def test_clusters_of_all_distances(spark, seed, n, k, rounds):
    rows = rows_of(seed, n)
    assert clustered(spark, rows, k, rounds) == brute(rows, k, rounds)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rng = random.Random(9)
    grid = [(i, [float(rng.randrange(2)) for _ in range(DIMS)]) for i in range(120)]  # many equal distances
    odd = [(500, None), (501, []), (502, [1.0] * (DIMS - 1)), (503, [1.0] * (DIMS + 1)), (504, [None] + [1.0] * (DIMS - 1)),
           (505, [float("nan")] * DIMS), (506, [float("inf")] * DIMS), (None, [0.5] * DIMS), (None, [0.5] * DIMS)]
    rows = grid + grid[:40] + odd + [(7, [0.25] * DIMS)]
    assert clustered(spark, rows, 14, 6) == brute(rows, 14, 6)


def test_one_vector_many_times(spark):
    rows = [(i, [1.0] * DIMS) for i in range(300)] + rows_of(6, 50)
    assert clustered(spark, rows, 20, 4) == brute(rows, 20, 4)


def test_empty_table_and_too_large_components(spark):
    assert clustered(spark, [], 5, 2) == Counter()
    with pytest.raises(Exception, match="too large"):
        clustered(spark, [(1, [1e9] * DIMS)], 5, 2)


def test_large_components_stay_exact():
    rng = np.random.default_rng(1)
    v, c = (rng.integers(-(1 << 26), 1 << 26, (20, 64)) for _ in range(2))
    wanted = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c] for x in v]
    assert centroids.squared(v, c).tolist() == wanted


def test_bounds_spare_distances_and_use_the_norm_of_the_sum(monkeypatch):
    v = (np.array([x for _, x in rows_of(8, 2000, 3.0)]) * 256).astype(np.int64)
    centres = v[:20].copy()
    history, groups = [centres], centroids.groups_of(centres)
    state, scanned = centroids.Bounds(history, groups).first(v), []
    plain = centroids.squared
    monkeypatch.setattr(centroids, "squared", lambda a, b: scanned.append(len(a) * len(b)) or plain(a, b))
    for _ in range(8):
        centres = np.stack([v[state[0] == n].sum(0) // max(1, (state[0] == n).sum()) if (state[0] == n).any() else c
                            for n, c in enumerate(centres)])
        history = [*history, centres]
        state = centroids.Bounds(history, groups).again(v, *state)
        assert (state[0] == plain(v, centres).argmin(1)).all()
    assert sum(scanned) < 8 * v.shape[0] * 20 / 3
    # a centroid that goes and comes back loosens nothing
    back = centroids.Bounds([history[0], history[1], history[0]], groups)
    assert (back.moved[0] == 0).all() and back.moved[1].any()
