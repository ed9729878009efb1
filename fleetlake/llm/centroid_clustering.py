"""Centroid clustering with equal-average equal-variance search (free style: Arrow batches).

Vectors are whole numbers, floor(``scale`` * x). Lloyd rounds start from the vectors with the least hash;
a round assigns every vector to its nearest centroid and replaces each centroid that has vectors by
their exact mean, rounded down. The nearest centroid is searched as follows. Centroids are sorted by the
sum of their components. For each vector the search goes outward from the vector's own sum. With d
components, sums s and t and deviations v and w (root of d times the sum of squares less the squared
sum), d times the squared distance of two vectors is at least (s - t)^2 + (v - w)^2. So the search of a
vector ends where (s - t)^2 alone exceeds d times the best distance so far, and a centroid that fails the
whole inequality on the way is passed over. All others get their exact whole-number distance. Bounds
reject only what is strictly farther, so ties still go to the smaller number.

Each round is one job over the stored whole-number vectors: a task sums its vectors per centroid and gives
out one row per (centroid, component), so the driver receives a table of k * d sums whatever the size
of the input, and a cluster that holds a third of all rows costs no more than another.

Results: vectors with a null, with a component that is null, NaN or infinite, or with another number of
components are left out. Components beyond +-2**22 after scaling (+-16,384 at 256) count as that
bound, which keeps all distances exact in 64-bit numbers. Rows with one identifier are vectors of their own; of
equal hashes the vector that is less, component by component, starts first. With fewer vectors than ``k``
there are fewer clusters; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import stored

SCALE = 256
LIMIT = 1 << 22
# Vectors searched at once.
SLICE = 4096


def whole_vectors(table: DataFrame, dimensions: int, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and the whole-number vector ``v`` of every usable row."""
    value = F.col("embedding")
    infinity = F.lit(float("inf"))
    usable = (F.size(value) == dimensions) & F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < infinity)
    )
    whole = F.transform(
        value, lambda x: F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))).cast("int")
    )
    return table.where(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v"))


class Searcher:
    """Nearest of whole-number ``centroids`` (k, d); of equally near ones the first."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.points = centroids[self.order].astype(np.float64)
        self.sums = sums[self.order]
        self.deviations = _deviations(centroids)[self.order]
        self.tested = 0  # exact distances taken so far

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the squared distance, for int64 ``vectors`` (n, d)."""
        n, d = vectors.shape
        k = len(self.order)
        sums, deviations, points = vectors.sum(axis=1), _deviations(vectors), vectors.astype(np.float64)
        best = np.full(n, np.iinfo(np.int64).max // d)
        number = np.full(n, k)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        alive = np.arange(n)
        while len(alive):
            # The nearer of the next sums on both sides.
            low, high = left[alive], right[alive]
            gap_low = np.where(low >= 0, sums[alive] - self.sums[low.clip(min=0)], np.iinfo(np.int32).max)
            gap_high = np.where(high < k, self.sums[high.clip(max=k - 1)] - sums[alive], np.iinfo(np.int32).max)
            down = gap_low <= gap_high
            at, gap = np.where(down, low, high), np.minimum(gap_low, gap_high)
            going = (at >= 0) & (at < k) & (gap * gap <= d * best[alive])
            alive, at, gap, down = alive[going], at[going], gap[going], down[going]
            left[alive] -= down
            right[alive] += ~down
            # A hair less than the computed difference, so that rounding rejects nothing.
            spread = np.abs(deviations[alive] - self.deviations[at])
            spread = np.maximum(0, spread - 1e-9 * (deviations[alive] + self.deviations[at]))
            close = gap.astype(np.float64) ** 2 + spread**2 <= d * best[alive].astype(np.float64) * (1 + 1e-12)
            who, at = alive[close], at[close]
            # Whole numbers below 2**53, so the sums are exact.
            difference = points[who] - self.points[at]
            distance = np.einsum("ij,ij->i", difference, difference).astype(np.int64)
            self.tested += len(who)
            named = self.order[at]
            better = (distance < best[who]) | ((distance == best[who]) & (named < number[who]))
            best[who[better]], number[who[better]] = distance[better], named[better]
        return number, best


def _deviations(vectors: np.ndarray) -> np.ndarray:
    """Root of d times the sum of squares less the squared sum; the radicand is exact."""
    return np.sqrt((vectors.shape[1] * (vectors * vectors).sum(axis=1) - vectors.sum(axis=1) ** 2).astype(np.float64))


def _slices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, part.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, d)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Vectors and exact component sums of each centroid's cluster."""
    k, d = centroids.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Searcher(centroids)
        counts, totals = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for _, whole in _slices(batches, d):
            number, _ = search(whole)
            counts += np.bincount(number, minlength=k)
            np.add.at(totals, number, whole)
        # Component d is the count.
        yield pa.record_batch(
            [
                pa.array(np.repeat(np.arange(k), d + 1), pa.int32()),
                pa.array(np.tile(np.arange(d + 1), k), pa.int32()),
                pa.array(np.column_stack([totals, counts]).ravel()),
            ],
            names=["cluster", "component", "total"],
        )

    parts = vectors.select("v").mapInArrow(work, "cluster int, component int, total bigint")
    out = [[0] * (d + 1) for _ in range(k)]
    for r in parts.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        out[r["cluster"]][r["component"]] = int(r["total"])
    return np.array([row[d] for row in out]), [row[:d] for row in out]


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the least hash of seed and identifier, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256).alias("__digest")
    rows = vectors.select(digest, "v").orderBy("__digest", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def fit(vectors: DataFrame, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centroids after ``rounds`` rounds; no centroid where there is no vector."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        counts, totals = _sums(vectors, centroids)
        centroids = np.array(
            [[t // int(n) for t in total] if n else old.tolist() for n, total, old in zip(counts, totals, centroids)],
            np.int64,
        )
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and squared ``distance`` of every vector."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Searcher(centroids)
        for part, whole in _slices(batches, centroids.shape[1]):
            number, distance = search(whole)
            yield pa.record_batch(
                [part.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance)],
                names=["vec_id", "cluster", "distance"],
            )

    return vectors.mapInArrow(work, "vec_id bigint, cluster int, distance bigint")


def cluster(
    table: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dimensions: int = 64, scale: int = SCALE
) -> DataFrame:
    """One row per usable vector: its cluster, squared distance, the sums of distances over its cluster and
    over all, and the hash of its centroid's components."""
    vectors = stored(whole_vectors(table, dimensions, scale), "whole-vectors")
    centroids = fit(vectors, k, rounds, seed)
    if not len(centroids):
        empty = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return table.sparkSession.createDataFrame([], empty)
    assigned = stored(assign(vectors, centroids), "assigned-vectors")
    # One row per cluster, at most k.
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    inertia = [0] * len(centroids)
    for r in sums:
        inertia[r["cluster"]] = r["inertia"]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of_cluster = F.col("cluster")
    return assigned.withColumns(
        {
            "cluster_inertia": F.get(F.array(*[F.lit(i).cast("bigint") for i in inertia]), of_cluster),
            "inertia": F.lit(sum(inertia)).cast("bigint"),
            "centroid_sha256": F.get(F.array(*map(F.lit, names)), of_cluster),
        }
    )
