"""Centroid clustering: exact integer k-means over a kept distance matrix.

A vector becomes integers floor(256 * x), so every dot product, sum and
distance is exact and a rerun agrees to the last unit.  The distance matrix
is never computed anew: a state table keeps, per vector, its dot products
with all centroids.  When a centroid moves, only its nonzero component
changes are multiplied and added (``updated``); a centroid that stays costs
nothing.  |x|^2 - 2 x.c + |c|^2 of the kept products gives the distances,
and argmin the cluster.

One round is one map over the state table (new products, new clusters,
written below the shared folder, after which the previous state is removed)
and one aggregate: tasks add up their vectors per cluster, so the shuffle
carries ``clusters`` rows a task and the driver gets ``clusters`` sums
however large a cluster is.

Edge cases: vectors that are null, of another length, or hold null or
non-finite components are not kept and return no row; a null vec_id keeps
its row and comes last as a starting centroid; repeated rows count as often
as they occur, ties among starting centroids go by components; with fewer
kept vectors than ``clusters`` there are as many centroids as vectors; an
empty table returns no row.  Components whose integers reach 2^27 have no
distance that fits a long: they raise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.session import scratch_path

from .textarrays import small_batches

DIMS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, 2
LIMIT = 1 << 27  # |integer component|: dims * (2 * LIMIT)^2 still fits a long
STATE = "vec_id long, x array<int>, dots array<long>, cluster int, distance long"


def product(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer matrix product; through floats where they hold it exactly."""
    if not x.size or not c.size:
        return np.zeros((x.shape[0], *c.shape[1:]), np.int64)
    if int(np.abs(x).max()) * int(np.abs(c).max()) * x.shape[1] < 1 << 53:
        return (x.astype(np.float64) @ c.astype(np.float64)).astype(np.int64)
    return x @ c


def updated(dots: np.ndarray, x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Products after centroid j moved by ``change[j]``: only its nonzero components are read."""
    out = dots.copy()
    for j in np.flatnonzero(change.any(axis=1)):
        moved = np.flatnonzero(change[j])
        out[:, j] += product(x[:, moved], change[j, moved])
    return out


def nearest(dots: np.ndarray, x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of each vector; ties go to the smaller number."""
    d = (centroids * centroids).sum(axis=1) - 2 * dots
    cluster = d.argmin(axis=1)  # the first of equal ones
    return cluster, d[np.arange(len(x)), cluster] + (x * x).sum(axis=1)


def integers(column: pa.Array, dims: int) -> np.ndarray:
    x = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, dims)
    if x.size and np.abs(x).max() >= LIMIT:
        raise ValueError(f"a component of {np.abs(x).max() / SCALE:g} has no squared distance that fits a long")
    return x.astype(np.int64)


def _rows(ids: pa.Array, x: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    cluster, distance = nearest(dots, x, centroids)

    def nested(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel(), kind), values.shape[1]).cast(pa.list_(kind))
    return pa.RecordBatch.from_arrays([ids, nested(x.astype(np.int32), pa.int32()), nested(dots, pa.int64()), pa.array(cluster.astype(np.int32)),
                                       pa.array(distance)], names=["vec_id", "x", "dots", "cluster", "distance"])


def _start(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = integers(b.column("embedding"), centroids.shape[1])
                yield _rows(b.column("vec_id"), x, product(x, centroids.T), centroids)
    return run


def _state(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(name).flatten().to_numpy().astype(np.int64).reshape(b.num_rows, -1)


def _step(change: np.ndarray, centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _state(b, "x")
                yield _rows(b.column("vec_id"), x, updated(_state(b, "dots"), x, change), centroids)
    return run


def _sums(clusters: int, dims: int):
    """Per task and cluster: vectors and component sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((clusters, dims), np.int64), np.zeros(clusters, np.int64)
        for b in batches:
            if b.num_rows:
                x, cluster = _state(b, "x"), b.column("cluster").to_numpy()
                order = np.argsort(cluster, kind="stable")
                own, first = np.unique(cluster[order], return_index=True)
                total[own] += np.add.reduceat(x[order], first, axis=0)
                count += np.bincount(cluster, minlength=clusters)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(count[own]), pa.array(total[own].tolist(), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "total"])
    return run


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each cluster; an empty one stays."""
    clusters, dims = centroids.shape
    parts = state.select("x", "cluster").mapInArrow(_sums(clusters, dims), "cluster int, n long, total array<long>")
    wide = "decimal(38,0)"
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i].cast(wide)) for i in range(dims)]).alias("total"))
    out = centroids.copy()
    for r in sums.collect():  # one row a cluster
        out[r["cluster"]] = [int(t) // r["n"] for t in r["total"]]
    return out


def kept_vectors(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """(vec_id, embedding) of the vectors with ``dims`` finite components."""
    fine = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    v = vectors.where(F.coalesce((F.size("embedding") == dims) & fine, F.lit(False)))
    return v.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cluster_vectors(vectors: DataFrame, dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Per kept row of ``vectors(vec_id, embedding, ..)``: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    small_batches(spark)
    v = kept_vectors(vectors, dims)
    shape = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = v.orderBy(F.asc_nulls_last(name), "embedding").limit(clusters).select("embedding").collect()
    if not first:
        return spark.createDataFrame([], shape)
    centroids = integers(pa.array([r[0] for r in first], pa.list_(pa.float64())), dims)

    def keep(df: DataFrame) -> tuple[str, DataFrame]:
        path = scratch_path(spark, "centroid-state")
        df.write.parquet(path)
        return path, spark.read.schema(STATE).parquet(path)
    path, state = keep(v.mapInArrow(_start(centroids), STATE))
    for _ in range(rounds):
        new = moved(state, centroids)
        change, centroids = new - centroids, new
        if not change.any():
            break  # nothing moves any more: further rounds repeat this one
        old = path
        path, state = keep(state.mapInArrow(_step(change, centroids), STATE))
        _remove(spark, old)
    sums = {r["cluster"]: int(r["s"]) for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    per = F.array(*[F.lit(sums.get(k, 0)).cast("long") for k in range(len(centroids))])
    sha = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids.tolist()])
    return state.select("vec_id", "cluster", "distance", per[F.col("cluster")].alias("cluster_inertia"),
                        F.lit(sum(sums.values())).cast("long").alias("inertia"), sha[F.col("cluster")].alias("centroid_sha256"))


def sql(dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """DuckDB text of ``cluster_vectors``: plain distances in every round."""
    parts = [f"""v AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {dims}
  AND list_count(list_filter(embedding, lambda e: isfinite(e))) = {dims})""",
             f"""p AS MATERIALIZED (SELECT vec_id, unnest(range({dims})) AS i,
  unnest(list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT))) AS x FROM v)""",
             f"""f AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS k FROM v QUALIFY k < {clusters})""",
             "c0 AS MATERIALIZED (SELECT k, i, x FROM f JOIN p USING (vec_id))"]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, min(CAST(d AS HUGEINT) * {clusters} + k) AS m FROM
  (SELECT vec_id, k, sum((p.x - c.x) * (p.x - c.x)) AS d FROM p JOIN c{r} c USING (i) GROUP BY vec_id, k) GROUP BY vec_id)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.k, c.i, coalesce(s.x, c.x) AS x FROM c{r} c LEFT JOIN
  (SELECT m % {clusters} AS k, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
   FROM a{r} JOIN p USING (vec_id) GROUP BY 1, 2) s ON s.k = c.k AND s.i = c.i)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(m % {clusters} AS INTEGER) AS "cluster", CAST(m // {clusters} AS BIGINT) AS distance,
  CAST(sum(m // {clusters}) OVER (PARTITION BY m % {clusters}) AS BIGINT) AS cluster_inertia, CAST(sum(m // {clusters}) OVER () AS BIGINT) AS inertia,
  h AS centroid_sha256 FROM a{rounds} JOIN (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k) ON k = m % {clusters}"""


SQL = sql()
