"""Centroid clustering of integer vectors with block-norm screening.

A vector is cut into segments and compressed to their norms, once. By Cauchy and Schwarz no
segment of vector and centroid can lie nearer than the difference of its norms, so the squared
differences of the norms add up to a lower bound of the distance. Centroids in turn get exact
integer distances only for the vectors whose bound does not pass the least distance met so far.

A round is one pass over the vectors: tasks hand on sums of components by cluster, which are
added up by cluster and component. The driver holds centroids only: their number times their width.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import stage
from .integer_vectors import integer_vectors, matrix_of

#: Components of a segment, and vectors that are screened together.
SEGMENT, TOGETHER = 4, 8192


def segment_norms(q: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """The compressed vectors: the norm of every ``segment`` components (the last segment may be shorter)."""
    cuts = np.arange(0, q.shape[1], segment)
    return np.sqrt(np.add.reduceat(q.astype(np.float64) ** 2, cuts, axis=1))


def assign(q: np.ndarray, norms: np.ndarray, centroids: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid (ties: the smaller number), and how many exact distances that took."""
    q, centroids = q.astype(np.int64), centroids.astype(np.int64)
    heads = segment_norms(centroids, segment)
    low = np.zeros((len(q), len(centroids)))
    for s in range(norms.shape[1]):  # as differences: sums of large squares would round away what small ones tell
        low += (norms[:, s, None] - heads[None, :, s]) ** 2
    low -= 1e-9 * low + 1e-3  # rounding never prunes
    cluster = low.argmin(axis=1)
    gap = q - centroids[cluster]
    least = np.einsum("ij,ij->i", gap, gap)
    first, exact = cluster.copy(), len(q)
    for j in range(len(centroids)):
        at = np.flatnonzero((low[:, j] <= least) & (first != j))
        if len(at):
            gap = q[at] - centroids[j]
            far = np.einsum("ij,ij->i", gap, gap)
            better = (far < least[at]) | ((far == least[at]) & (j < cluster[at]))
            least[at[better]], cluster[at[better]] = far[better], j
            exact += len(at)
    return cluster, least, exact


def starts(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors (all with an id, if fewer) whose ``salt``:id has the smallest SHA-256, in its order."""
    chosen = vectors.filter(F.col("vec_id").isNotNull()).withColumn("h", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256))
    return np.array([r.q for r in chosen.orderBy("h", "q").limit(k).select("q").collect()], np.int64)


def floor_means(sums: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """floor(sum / count) for every cluster of ``sums`` (cluster, place, total, n); others stay as they are."""
    out = centroids.copy()
    for r in sums.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # k rows for each component
        out[r.cluster, r.place] = r.total // r.n
    return out


def cluster(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    width: int | None = None,
    scale: int = 256,
    salt: str = "2",
    segment: int = SEGMENT,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row for every vector that takes part, after ``rounds`` rounds.

    Components x become floor(scale * x). Vectors of another width (than most, if ``width`` is None), null ones, those with null or non-finite
    components and those beyond ``integer_vectors.most_component`` take no part. Rows without id are clustered,
    but no start; rows of one id each count. With fewer vectors than k there are as many centroids as vectors
    with an id; without any, as in an empty table, there are no rows. A tie between centroids goes to the smaller
    number; a cluster without vectors keeps its centroid. An inertia that a long does not hold is null.
    Only the two named columns are read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows, width = integer_vectors(vectors, vector, scale, width, F.col(id_column).cast("long").alias("vec_id"))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms = segment_norms(matrix_of(batch.column(1), width), segment)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(norms.reshape(-1)), norms.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["vec_id", "q", "norms"])

    schema = "vec_id long, q array<int>, norms array<double>"
    rows = stage(rows.mapInArrow(compress, schema) if width else spark.createDataFrame([], schema), "vectors")
    centroids = starts(rows, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    segments = -(-width // segment)

    def screened(batch: pa.RecordBatch, heads: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        for at in range(0, batch.num_rows, TOGETHER):
            some = batch.slice(at, TOGETHER)
            q = matrix_of(some.column(1), width)
            nearest, far, _ = assign(q, matrix_of(some.column(2), segments), heads, segment)
            yield some, q, nearest, far

    def totals(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros(shared.value.shape, np.int64), np.zeros(len(shared.value), np.int64)
            for batch in batches:
                for _, q, nearest, _ in screened(batch, shared.value):
                    n += np.bincount(nearest, minlength=len(n))
                    order = np.argsort(nearest, kind="stable")
                    own, begins = np.unique(nearest[order], return_index=True)
                    total[own] += np.add.reduceat(q[order].astype(np.int64), begins, axis=0)
            met = np.flatnonzero(n)
            if len(met):
                columns = [np.repeat(met, width).astype(np.int32), np.tile(np.arange(width, dtype=np.int32), len(met)), total[met].reshape(-1), np.repeat(n[met], width)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "place", "total", "n"])

        return run

    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centroids)
        centroids = floor_means(rows.mapInArrow(totals(shared), "cluster int, place int, total long, n long"), centroids)
        shared.unpersist()
    shared = spark.sparkContext.broadcast(centroids)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, _, nearest, far in screened(batch, shared.value):
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(nearest.astype(np.int32)), pa.array(far)], names=["vec_id", "cluster", "distance"])

    found = stage(rows.mapInArrow(last, "vec_id long, cluster int, distance long"), "assigned")
    exact = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("own"))
    exact = stage(exact.withColumn("every", F.lit(1)), "inertia")  # a row for each cluster
    total = exact.groupBy("every").agg(F.sum("own").alias("all"))
    names = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())]
    sums = exact.join(F.broadcast(total), "every").join(F.broadcast(spark.createDataFrame(names, "cluster int, centroid_sha256 string")), "cluster")
    sums = sums.select("cluster", F.col("own").try_cast("long").alias("cluster_inertia"), F.col("all").try_cast("long").alias("inertia"), "centroid_sha256")
    return found.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, salt: str = "2") -> str:
    """DuckDB SQL for ``cluster`` of embeddings, with every distance computed."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""far{r} AS (SELECT v.row, c.cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance FROM parts v JOIN centroids{r} c ON v.place = c.place GROUP BY v.row, c.cluster),
near{r} AS (SELECT row, cluster, distance FROM far{r} QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)""")
        if r < rounds:
            steps.append(f"""means{r} AS (SELECT n.cluster, v.place, CAST(sum(v.x) AS BIGINT) AS s, count(*) AS n FROM parts v JOIN near{r} n ON v.row = n.row GROUP BY n.cluster, v.place),
centroids{r + 1} AS (SELECT c.cluster, c.place, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x) AS x FROM centroids{r} c LEFT JOIN means{r} m ON m.cluster = c.cluster AND m.place = c.place)""")
    body = ",\n".join(steps)
    return f"""
WITH kept AS (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT row, unnest(range(1, {width + 1})) AS place, unnest(q) AS x FROM kept),
first AS (SELECT row, row_number() OVER (ORDER BY sha256('{salt}:' || CAST(vec_id AS VARCHAR)), q) - 1 AS cluster FROM kept WHERE vec_id IS NOT NULL QUALIFY cluster < {k}),
centroids0 AS (SELECT f.cluster, p.place, p.x FROM first f JOIN parts p ON p.row = f.row),
{body},
named AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256 FROM centroids{rounds} GROUP BY cluster)
SELECT k.vec_id, CAST(n.cluster AS INT) AS cluster, n.distance, CAST(sum(n.distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(n.distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept k JOIN near{rounds} n ON n.row = k.row JOIN named ON named.cluster = n.cluster
"""
