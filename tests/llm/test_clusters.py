"""VA-file clustering against plain integers."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeplan.llm import va_clusters as va

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k, rounds, dims, scale=64, salt="1"):
    """Plain Python integers throughout."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [max(-va.BOUND, min(va.BOUND, int(np.floor(min(max(x, -1e300), 1e300) * scale)))) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest()))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        owner = [nearest(v)[1] for _, v in kept]
        for i in range(len(centroids)):
            own = [v for (_, v), o in zip(kept, owner, strict=True) if o == i]
            if own:
                centroids[i] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    last = [nearest(v) for _, v in kept]
    sums = {c: sum(d for d, o in last if o == c) for _, c in last}
    return sorted((str(i), c, d, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                  for (i, _), (d, c) in zip(kept, last, strict=True))


def got(df, **args):
    return sorted((str(r[0]), *r[1:]) for r in va.clusters(df, **args).collect())


@pytest.mark.parametrize("dims,spread", [(8, 1.0), (7, 0.02), (3, 40.0)])
def test_clusters_equal_plain_integers(spark, dims, spread):
    rng = random.Random(dims)
    rows = [(i, [rng.gauss((i % 5) * spread, spread) for _ in range(dims)]) for i in range(400)]
    rows += [(7, rows[7][1]), (7, [0.0] * dims), (1000, rows[3][1]), (1001, [spread] * dims), (1002, [spread] * dims)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got(df, k=6, rounds=3, dims=dims) == brute(rows, 6, 3, dims)


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [1.0, nan]), (6, [inf, 1.0]), (None, [0.5, 0.5]), (8, [1e300, -1e300]),
            (9, [0.25, -0.25]), (None, [0.5, 0.5]), (10, [-0.001, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("clash") for n in ("cluster", "cells", "vector", "distance", "dim")})
    assert got(df, k=16, dims=2) == brute(rows, 16, 3, 2)
    assert va.clusters(df.limit(0)).collect() == [] == va.clusters(df, dims=9).collect()
    assert va.clusters(df.limit(0)).columns == va.clusters(df, dims=2).columns


def test_cells_spare_most_distances(spark):
    rng = random.Random(3)
    middles = [[rng.uniform(-1, 1) for _ in range(16)] for _ in range(8)]
    rows = [(i, [rng.gauss(m, 0.1) for m in middles[i % 8]]) for i in range(2000)]
    kept = va.kept_vectors(spark.createDataFrame(rows, SCHEMA), 16, "vec_id", "embedding")
    cells = va.fitted_cells(kept, 16, 64)
    index = va.va_file(kept, cells, 64)
    centroids = va.moved_centroids(index, cells, va.seeds(index, 8, "1"))
    n, fetched, distances = va.overlap_share(index, cells, centroids)
    assert n == 2000 and fetched < 0.6 * n and distances < 0.25 * n * 8


def test_intervals_hold_every_distance():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-40, 40, (300, 5))
    low = np.array([[-40, *sorted(rng.integers(-30, 30, 15))]] * 5)
    high = np.column_stack([np.maximum(low[:, 1:] - 1, low[:, :-1]), np.full(5, 40)])
    cells, centroids = va.Cells(low, high), rng.integers(-50, 50, (4, 5))
    packed, (least, most) = cells.of(vectors), cells.tables(centroids)
    lower, upper = (sum(t[p][packed[:, p]] for p in range(packed.shape[1])) for t in (least, most))
    exact = ((vectors[:, None] - centroids[None]) ** 2).sum(2)
    assert (lower <= exact).all() and (exact <= upper).all()
