"""Approximate nearest neighbours by an inverted multi-index.

Each vector, scaled to length one, is cut in two halves, and each half is quantised by
its own codebook of ``CENTROIDS`` centroids (k-means on a bounded, hash-drawn sample of
``SAMPLE`` vectors). A pair of centroids is a cell; every row is indexed under its cell.

A query ranks the centroids of either half by distance and walks the grid of pairs
by summed distance with a heap (multi-sequence traversal), until the cells it has
visited hold ``PROBE_SHARE`` of all entries. The entries of those cells are reranked by
the exact cosine in double precision. On vectors without structure the nearest ones are
spread over many cells; the share is set for a recall of 0.9 on such vectors.

The index is dealt to shards by a hash of the id, and queries to blocks; one task holds
one shard's inverted lists and one block of queries, both bounded, and returns the
best k of each query in that shard. The best k of all shards follow by rank. A cell
that holds a third of all rows, or a crowd of copies, is spread over all shards.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortwatch.llm.common import importable, map_arrow, table
from cohortwatch.session import cut_lineage

CENTROIDS = 32
SAMPLE = 20_000
ROUNDS = 15
PROBE_SHARE = 0.6
SHARD_ROWS = 4096
BLOCK_ROWS = 1024
SEED = 11


def usable_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>): one row per id, of the commonest dimension.

    Rows with a null id, and vectors that are null, empty, zero or hold null, NaN or
    infinite components take no part. Of repeated ids the least vector stays.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0))
    rows = rows.where(finite & F.exists("embedding", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(values: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if len(values) == 0:
        return np.zeros((0, 0))
    return np.asarray(values.flatten(), dtype=np.float64).reshape(len(values), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every centroid."""
    return (points * points).sum(axis=1)[:, None] - 2 * points @ centroids.T + (centroids * centroids).sum(axis=1)


def kmeans(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    points = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centroids = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(ROUNDS):
        nearest = distances(points, centroids).argmin(axis=1)
        size = np.bincount(nearest, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, nearest, points)
        centroids = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centroids)
    return centroids


@dataclass
class Codebooks:
    """Centroids of the two halves; a cell is first * len(right) + second."""

    left: np.ndarray
    right: np.ndarray

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u = unit(vectors)
        cut = self.left.shape[1]
        return u[:, :cut], u[:, cut:]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = self.halves(vectors)
        return distances(a, self.left).argmin(axis=1) * len(self.right) + distances(b, self.right).argmin(axis=1)

    def traverse(self, vector: np.ndarray, sizes: np.ndarray, least: int):
        """Cells by summed distance of their centroid pair, until they hold ``least`` entries."""
        a, b = self.halves(vector[None, :])
        da, db = distances(a, self.left)[0], distances(b, self.right)[0]
        ia, ib = np.argsort(da, kind="stable"), np.argsort(db, kind="stable")
        sa, sb = da[ia].tolist(), db[ib].tolist()
        heap, seen, held = [(sa[0] + sb[0], 0, 0)], {(0, 0)}, 0
        while heap and held < least:
            _, i, j = heapq.heappop(heap)
            cell = int(ia[i]) * len(sb) + int(ib[j])
            held += int(sizes[cell])
            yield cell
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(sa) and y < len(sb) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (sa[x] + sb[y], x, y))


def fit_codebooks(vectors: DataFrame, n: int, centroids: int = CENTROIDS, sample: int = SAMPLE) -> Codebooks:
    """k-means of both halves on at most about ``sample`` vectors, drawn by a hash of the id."""
    share = int(min(1.0, sample / max(1, n)) * (1 << 30))
    drawn = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < share) if n > sample else vectors
    rows = sorted((r["vec_id"], r["embedding"]) for r in drawn.collect())
    points = unit(np.array([r[1] for r in rows], dtype=np.float64))
    cut = (points.shape[1] + 1) // 2
    return Codebooks(kmeans(points[:, :cut], centroids, SEED), kmeans(points[:, cut:], centroids, SEED + 1))


def best_in_shard(k: int):
    """Rerank, for each query of a block, the shard's entries in the cells that it visits."""
    def search(entries: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if entries.num_rows and queries.num_rows:
            ids, m = entries.column("vec_id").to_numpy(), matrix(entries.column("embedding"))
            order = np.argsort(entries.column("cell").to_numpy(), kind="stable")  # the inverted lists, one after the other
            ids, m, cell = ids[order], m[order], entries.column("cell").to_numpy()[order]
            u = unit(m)
            for query_id, vector, visited in zip(queries.column("vec_id").to_pylist(), unit(matrix(queries.column("embedding"))), queries.column("visited").to_pylist()):
                bits = np.unpackbits(np.frombuffer(visited, dtype=np.uint8))
                found = np.flatnonzero((bits[cell] == 1) & (ids != query_id))
                score = (u[found] * vector).sum(axis=1)
                if len(found) > k:
                    near = np.flatnonzero(score >= np.partition(score, -k)[-k])
                    found, score = found[near], score[near]
                best = np.lexsort((ids[found], -score))[:k]
                out["query_id"] += [query_id] * len(best)
                out["vec_id"] += ids[found[best]].tolist()
                out["score"] += score[best].tolist()
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    return search


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, probe_share: float = PROBE_SHARE,
            centroids: int = CENTROIDS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query, by cosine.

    ``vectors`` and ``queries`` hold (vec_id, embedding); a query that cannot take part
    (see ``usable_vectors``) gives no rows, and a query's own id is no candidate. With
    fewer candidates than k all of them come. Ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    importable(spark)
    result = "query_id long, rank int, vec_id long, score double"
    usable = cut_lineage(usable_vectors(vectors))
    sizes = [(r["n"], -r["d"]) for r in usable.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).collect()]
    if not sizes:
        return spark.createDataFrame([], result)
    n, d = max(sizes)
    usable = usable.where(F.size("embedding") == -d)
    books = fit_codebooks(usable, n, centroids)

    def indexed(batch: pa.RecordBatch) -> dict:
        cells = books.cells(matrix(batch.column("embedding"))) if batch.num_rows else []
        return {"vec_id": batch.column("vec_id"), "embedding": batch.column("embedding"), "cell": pa.array(cells, pa.int32())}

    index = cut_lineage(map_arrow(usable, indexed, "vec_id long, embedding array<double>, cell int"))
    held = np.zeros(len(books.left) * len(books.right), dtype=np.int64)
    for r in index.groupBy("cell").count().collect():  # at most CENTROIDS squared rows
        held[r["cell"]] = r["count"]
    least = max(k + 1, int(np.ceil(probe_share * n)))

    def routed(batch: pa.RecordBatch) -> dict:
        visited = []
        for vector in matrix(batch.column("embedding")):
            bits = np.zeros(len(held), dtype=np.uint8)
            bits[list(books.traverse(vector, held, least))] = 1
            visited.append(np.packbits(bits).tobytes())
        return {"vec_id": batch.column("vec_id"), "embedding": batch.column("embedding"), "visited": visited}

    asked = usable_vectors(queries).where(F.size("embedding") == -d)
    asked = cut_lineage(map_arrow(asked, routed, "vec_id long, embedding array<double>, visited binary"))
    shards, blocks = -(-n // shard_rows), max(1, -(-asked.count() // BLOCK_ROWS))

    def dealt(df: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)))
        return df.withColumn(own, F.pmod(F.xxhash64(F.col("vec_id"), F.lit(SEED)), F.lit(own_n)).cast("int")).withColumn(other, every)

    entries = dealt(index, "shard", shards, "block", blocks).groupBy("shard", "block")
    questions = dealt(asked, "block", blocks, "shard", shards).groupBy("shard", "block")
    found = entries.cogroup(questions).applyInArrow(best_in_shard(k), "query_id long, vec_id long, score double")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of every vector whose id is divisible by 50, among all vectors."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(vectors, vectors.where(F.pmod("vec_id", F.lit(50)) == 0))
