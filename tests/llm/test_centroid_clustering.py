"""Equal-average equal-variance search and the clustering, against all distances."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm import centroid_clustering as cc
from fleetlake.llm import queries

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
     *[T.StructField(n, T.StringType()) for n in ("v", "cluster", "distance", "label")]]
)


def plain(rows, k, rounds, seed, d=64, scale=256):
    """(vec_id, cluster, distance, cluster inertia, inertia, hash) of every usable row."""
    usable = [(i, e) for i, e in rows if e is not None and len(e) == d and all(x is not None and np.isfinite(x) for x in e)]
    vectors = [(i, [max(-cc.LIMIT, min(cc.LIMIT, int(np.floor(scale * float(x))))) for x in e]) for i, e in usable]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(((name(i), v) for i, v in vectors))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in vectors]
        for j in range(len(centroids)):
            if mine := [v for (_, v), o in zip(vectors, of) if o == j]:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, *nearest(v)) for i, v in vectors]
    inertia = [sum(dist for _, dist, j in found if j == c) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, dist, inertia[j], sum(inertia), digest[j]) for i, dist, j in found), key=repr)


def got(df):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, e, "x", "x", "x", "x") for i, e in rows], SCHEMA)


@pytest.mark.parametrize("spread", [1, 40, 4000, 3e6])
@pytest.mark.parametrize("k", [1, 2, 40])
def test_search_finds_the_first_of_the_nearest(spread, k):
    rng = np.random.default_rng(int(spread) + k)
    centroids = (rng.normal(size=(k, 64)) + rng.normal(size=(k, 1))) * spread
    centroids = centroids.clip(-cc.LIMIT, cc.LIMIT).astype(np.int64)
    centroids[-1] = centroids[0]  # equally near
    near = centroids[rng.integers(k, size=500)] + rng.integers(-3, 4, size=(500, 64))
    vectors = np.concatenate([near, (rng.normal(size=(2000, 64)) * spread).astype(np.int64), centroids]).clip(-cc.LIMIT, cc.LIMIT)
    search = cc.Searcher(centroids)
    number, best = search(vectors)
    distances = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=-1)
    assert (number == distances.argmin(axis=1)).all() and (best == distances.min(axis=1)).all()
    assert search.tested <= len(vectors) * k


def test_search_rejects_by_sum_and_by_deviation():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-50, 50, size=(4000, 64))
    by_sum = rng.integers(-50, 50, size=(40, 64)) + 100 * np.arange(40)[:, None]
    search = cc.Searcher(by_sum)
    search(vectors)
    assert search.tested < 3 * len(vectors)
    # Equal sums, so that only deviations differ.
    by_deviation = np.tile([1, -1], 32) * (40 * np.arange(1, 41))[:, None]
    search = cc.Searcher(by_deviation)
    search(vectors)
    assert search.tested < 20 * len(vectors)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=64) / 4).tolist()) for i in range(120)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, rows[10][1])]
    rows += [(200, None), (201, []), (202, [0.0] * 63), (203, [0.0] * 65), (204, [None] + [0.0] * 63)]
    rows += [(205, [float("nan")] + [0.0] * 63), (206, [float("inf")] + [0.0] * 63), (207, [1e300] * 64)]
    for k in (1, 5, 40, 500):
        assert got(cc.cluster(table(spark, rows), k=k, rounds=3)) == plain(rows, k, 3, 2)


def test_copies_leave_clusters_empty(spark):
    rows = [(i, [0.5] * 64) for i in range(50)] + [(i, [i / 100] * 64) for i in range(50, 60)]
    assert got(cc.cluster(table(spark, rows), k=8)) == plain(rows, 8, 5, 2)


def test_no_usable_rows(spark):
    out = cc.cluster(table(spark, [(1, None)]))
    assert out.count() == 0 and out.columns == cc.cluster(table(spark, [(1, [0.0] * 64)])).columns


def test_query(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.col("embedding"))
    assert got(queries.op13_equal_average_clustering(spark, SF)) == plain([tuple(r) for r in frame.collect()], 40, 5, 2)
