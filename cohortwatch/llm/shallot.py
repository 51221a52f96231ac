"""Centroid clustering in integers by Shallot search.

Components become integers floor(64 * x). Every vector carries the number of its
centroid, that of the second-nearest one, an upper bound of its distance to the first and
a lower bound of that to all others. When centroids move, the upper bound grows by
the step of the vector's own centroid and the lower one falls by the longest step of the
others. A vector whose upper bound is below its lower one, or below half the distance of
its centroid to the next centroid, keeps its centroid without looking at any. For the
others the distances to both remembered centroids are computed, and the search starts at
the closer one, a: its neighbours, sorted by distance from a, are scanned while that
distance is within d(x, a) + d(x, second best so far), a ball that shrinks as soon as a
better second is found (the triangle inequality rules out all beyond it). Survivors are
compared by exact squared distances in 64-bit integers, ties by the smaller number; only
bounds are floating point, widened by more than their rounding error.

Each pass is one ``mapInArrow`` over Parquet slices; the state of a vector is written with it,
so a lost executor repeats its own slice of one round only. The centroids (16 x 64 integers)
go along with the task. Sums of a cluster are partial aggregates, so a cluster that holds a
third of all rows sends as much as another: one row a task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm.common import map_arrow, stored, table

DIM = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = "1"
# Integers up to this size keep every squared distance of 64 components below 2^62.
LARGEST = 1 << 27
# Relative slack of the bounds, far above the rounding of a square root and a few sums.
SLACK = 1e-12
STATE = "vec_id long, point array<int>, cluster int, second int, upper double, lower double, distance long, scanned int"


def usable_points(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, point array<int>) of vectors with ``dim`` components, none null or non-finite."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(LARGEST / scale)))
    point = F.transform("embedding", lambda x: F.floor(x * F.lit(float(scale))).cast("int"))
    return rows.where((F.size("embedding") == dim) & sound).select("vec_id", point.alias("point"))


def points_of(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("point")
    return np.asarray(lists.flatten(), dtype=np.int64).reshape(batch.num_rows, -1)


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of each point to the centroid in the same row."""
    gap = points - centroids
    return (gap * gap).sum(axis=1)


def above(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 + SLACK)


def below(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 - SLACK)


@dataclass
class Centroids:
    """Integer centroids with what the search needs of them, and how far each has moved at most."""

    points: np.ndarray
    moved: np.ndarray

    def __post_init__(self) -> None:
        k = len(self.points)
        gaps = np.stack([squared(self.points, np.broadcast_to(p, self.points.shape)) for p in self.points]) if k else np.zeros((0, 0), np.int64)
        # neighbours of each centroid from the nearest on, without itself
        own = np.eye(k, dtype=bool)
        self.near = np.argsort(np.where(own, -1, gaps), axis=1, kind="stable")[:, 1:]
        self.gap = below(np.take_along_axis(gaps, self.near, axis=1))
        self.half_gap = self.gap[:, 0] / 2 if k > 1 else np.full(k, np.inf)
        order = np.argsort(self.moved)
        # longest step of the other centroids
        self.others = np.full(k, self.moved[order[-1]] if k else 0.0)
        if k > 1:
            self.others[order[-1]] = self.moved[order[-2]]

    def search(self, points: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(nearest, second, squared distances to both, centroids scanned), starting from two remembered centroids."""
        d_one, d_two = squared(points, self.points[one]), squared(points, self.points[two])
        swap = (d_two < d_one) | ((d_two == d_one) & (two < one))
        start = np.where(swap, two, one)
        best, second = start.copy(), np.where(swap, one, two)
        d_best, d_second = np.where(swap, d_two, d_one), np.where(swap, d_one, d_two)
        from_start = above(d_best)
        looked = np.full(len(points), 2)
        rows = np.arange(len(points))
        for j in range(self.near.shape[1]):
            # the ball around the start: beyond it no centroid is nearer than the second best
            rows = rows[self.gap[start[rows], j] <= from_start[rows] + above(d_second[rows])]
            if not len(rows):
                break
            c = self.near[start[rows], j]
            fresh = (c != one[rows]) & (c != two[rows])
            r, c = rows[fresh], c[fresh]
            d = squared(points[r], self.points[c])
            looked[r] += 1
            first = (d < d_best[r]) | ((d == d_best[r]) & (c < best[r]))
            next_ = ~first & ((d < d_second[r]) | ((d == d_second[r]) & (c < second[r])))
            second[r] = np.where(first, best[r], np.where(next_, c, second[r]))
            d_second[r] = np.where(first, d_best[r], np.where(next_, d, d_second[r]))
            best[r], d_best[r] = np.where(first, c, best[r]), np.where(first, d, d_best[r])
        return best, second, d_best, d_second, looked


def assign(centroids: Centroids, last: bool):
    """One pass over vectors and their state; ``last`` asks for the exact distance of all."""
    k = len(centroids.points)

    def made(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        if n == 0:
            return {f.split()[0]: [] for f in STATE.split(", ")}
        points = points_of(batch)
        cluster, second = batch.column("cluster").to_numpy().copy(), batch.column("second").to_numpy().copy()
        upper = batch.column("upper").to_numpy() + centroids.moved[cluster]
        lower = batch.column("lower").to_numpy() - centroids.others[cluster]
        distance, scanned = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int32)
        safe = np.maximum(lower, centroids.half_gap[cluster])
        doubt = np.flatnonzero(upper >= safe) if k > 1 else np.arange(0)
        # a tight upper bound often settles it
        tight = squared(points[doubt], centroids.points[cluster[doubt]])
        upper[doubt], distance[doubt], scanned[doubt] = above(tight), tight, 1
        doubt = doubt[upper[doubt] >= safe[doubt]]
        if len(doubt):
            best, other, d_best, d_second, looked = centroids.search(points[doubt], cluster[doubt], second[doubt])
            cluster[doubt], second[doubt], distance[doubt] = best, other, d_best
            upper[doubt], lower[doubt], scanned[doubt] = above(d_best), below(d_second), looked
        if last:
            open_ = np.flatnonzero(distance < 0)
            distance[open_] = squared(points[open_], centroids.points[cluster[open_]])
        return {"vec_id": batch.column("vec_id"), "point": batch.column("point"), "cluster": cluster, "second": second,
                "upper": upper, "lower": lower, "distance": distance, "scanned": scanned}

    return made


def first_centroids(points: DataFrame, k: int, seed: str, dim: int) -> np.ndarray:
    """The k points of least sha256 of ``seed:vec_id`` (null id: empty), equal hashes by their components."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.select(drawn.alias("draw"), "point").orderBy("draw", "point").limit(k).collect()
    return np.array([r["point"] for r in rows], dtype=np.int64).reshape(len(rows), dim)


def moved_centroids(state: DataFrame, before: np.ndarray) -> Centroids:
    """Floor of the mean of every cluster, one partial sum a task and cluster; empty ones stay."""
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), F.array(*[F.sum(F.col("point")[i].cast("long")) for i in range(before.shape[1])]).alias("sums"))
    after = before.copy()
    for r in sums.collect():  # at most one row a centroid
        after[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return Centroids(after, above(squared(after, before)))


def fit_clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, dim: int = DIM,
                 scale: int = SCALE) -> tuple[np.ndarray, DataFrame]:
    """Final centroids, and every vector's state (columns of STATE) after its last assignment.

    ``scanned`` is the number of centroids that the last pass computed a distance to.
    """
    points = stored(usable_points(vectors, dim, scale), "points")
    start = first_centroids(points, k, seed, dim)
    centroids = Centroids(start, np.zeros(len(start)))
    # nothing is known yet: centroids 0 and 1 are remembered, and no bound holds
    state = points.select("vec_id", "point", F.lit(0).alias("cluster"), F.lit(min(1, max(0, len(start) - 1))).alias("second"),
                          F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower"))
    for turn in range(rounds + 1):
        state = stored(map_arrow(state, assign(centroids, turn == rounds), STATE), f"clusters_{turn}")
        if turn < rounds:
            centroids = moved_centroids(state, centroids.points)
    return centroids.points, state


def cluster_vectors(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, second, scanned of every usable vector.

    ``vectors`` needs vec_id and embedding; other columns are ignored. Vectors that are
    null, of another length than 64, or hold null, NaN or infinite components take no part,
    nor do those with a component beyond 2^27 / 64, whose squared distances might not fit a
    long. Equal vectors get equal rows; a repeated id is a vector of its own each time; a
    null id hashes like an empty one and is kept. With fewer than ``k`` vectors there are as
    many centroids as vectors; equal centroids: the smaller number takes all. An inertia
    that does not fit a long is null. An empty table gives an empty one.
    """
    centroids, state = fit_clusters(vectors, k, rounds, seed)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    by_cluster = state.groupBy("cluster").agg(total.alias("sum")).collect()  # at most one row a centroid
    whole = sum(r["sum"] for r in by_cluster)
    fits = lambda v: int(v) if v < 1 << 63 else None
    rows = [(r["cluster"], fits(r["sum"]), fits(whole), names[r["cluster"]]) for r in by_cluster]
    about = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "second", "scanned")


def op11_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every embedding, its squared distance and the clusters' inertia."""
    made = cluster_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return made.drop("second", "scanned")


def _sql() -> str:
    """The same rounds as plain scans: every vector against every centroid, exactly."""
    steps = []
    for turn in range(ROUNDS + 1):
        steps.append(f"""
near{turn} AS (
  SELECT row_id, arg_min(cluster, d * {CENTROIDS} + cluster) AS cluster, min(d) AS distance FROM (
    SELECT p.row_id, c.cluster, CAST(list_sum(list_transform(range(1, {DIM + 1}), lambda i: (p.point[i] - c.point[i]) * (p.point[i] - c.point[i]))) AS BIGINT) AS d
    FROM points p CROSS JOIN cents{turn} c)
  GROUP BY row_id)""")
        if turn < ROUNDS:
            steps.append(f"""
parts{turn} AS (
  SELECT n.cluster, i, CAST(floor(sum(p.point[i])::DOUBLE / count(*)) AS BIGINT) AS mean
  FROM near{turn} n JOIN points p USING (row_id) CROSS JOIN (SELECT unnest(range(1, {DIM + 1})) AS i) GROUP BY n.cluster, i),
cents{turn + 1} AS (
  SELECT c.cluster, coalesce(m.point, c.point) AS point
  FROM cents{turn} c LEFT JOIN (SELECT cluster, list(mean ORDER BY i) AS point FROM parts{turn} GROUP BY cluster) m USING (cluster))""")
    return rf"""
WITH kept AS (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS point
  FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
points AS MATERIALIZED (SELECT * FROM kept),
cents0 AS (
  SELECT row_number() OVER (ORDER BY draw, point) - 1 AS cluster, point
  FROM (SELECT sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS draw, point FROM points ORDER BY draw, point LIMIT {CENTROIDS})),
{",".join(steps)},
total AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM near{ROUNDS} GROUP BY cluster)
SELECT p.vec_id, CAST(n.cluster AS INTEGER) AS cluster, n.distance, t.cluster_inertia,
       CAST((SELECT sum(distance) FROM near{ROUNDS}) AS BIGINT) AS inertia, sha256(array_to_string(c.point, ',')) AS centroid_sha256
FROM near{ROUNDS} n JOIN points p USING (row_id) JOIN total t USING (cluster) JOIN cents{ROUNDS} c USING (cluster)
"""


SQL = _sql()
