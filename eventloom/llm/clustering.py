"""Centroid clustering of integer vectors with Hamerly's bounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import by_batch, cut, release
from eventloom.llm.integers import summed_by, whole_vectors

STATE = "vec_id long, v binary, cluster int, upper double, lower double"
#: Vectors that are held against all centroids at once.
SCANNED = 256


def _raised(x: np.ndarray) -> np.ndarray:
    """At least the real number of which x is a rounding, as long as that takes few operations."""
    return x + np.abs(x) * 2.0**-50


def _lowered(x: np.ndarray) -> np.ndarray:
    return x - np.abs(x) * 2.0**-50


def scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of x: its nearest centroid (ties: the smaller number), bounds above its distance and below the second one's."""
    cluster, upper, lower = np.zeros(len(x), np.int32), np.zeros(len(x)), np.full(len(x), np.inf)
    for at in range(0, len(x), SCANNED):
        some = slice(at, at + SCANNED)
        squares = ((x[some, None, :] - centroids[None]) ** 2).sum(axis=2)
        cluster[some] = squares.argmin(axis=1)
        own = cluster[some, None]
        upper[some] = _raised(np.sqrt(np.take_along_axis(squares, own, 1)[:, 0]))
        if len(centroids) > 1:
            np.put_along_axis(squares, own, np.iinfo(np.int64).max, 1)
            lower[some] = _lowered(np.sqrt(squares.min(axis=1)))
    return cluster, upper, lower


def own_squares(x: np.ndarray, cluster: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((x - centroids[cluster]) ** 2).sum(axis=1)


def reassign(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The cluster and bounds of each row of x after its centroids moved by at most drift, and how many rows were scanned.

    The upper bound grows by the own centroid's drift, the lower one shrinks by the largest drift of another. While the
    upper one is below the lower one, the own centroid is the nearest one, without a tie. If not, the exact distance to
    it is tried as upper bound, and what is left is scanned.
    """
    others = np.array([max(np.delete(drift, k), default=0.0) for k in range(len(drift))])
    cluster, upper, lower = cluster.copy(), _raised(upper + drift[cluster]), _lowered(lower - others[cluster])
    unsure = np.flatnonzero(~(upper < lower))
    upper[unsure] = _raised(np.sqrt(own_squares(x[unsure], cluster[unsure], centroids)))
    unsure = unsure[~(upper[unsure] < lower[unsure])]
    cluster[unsure], upper[unsure], lower[unsure] = scan(x[unsure], centroids)
    return cluster, upper, lower, len(unsure)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, dim).astype(np.int64)


def _starts(vectors: DataFrame, dim: int, scale: int, clusters: int, seed: int) -> np.ndarray:
    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, x = whole_vectors(batch.column(1), scale, dim)
        return pa.record_batch([batch.column(0).filter(pa.array(keep)), pa.array(list(x), pa.list_(pa.int64()))], ["vec_id", "v"])

    named = by_batch(vectors, kernel, "vec_id long, v array<long>").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    rows = named.orderBy(F.asc_nulls_last("h"), "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64).reshape(-1, dim)


def _assigned(vectors: DataFrame, dim: int, scale: int, centroids: np.ndarray) -> DataFrame:
    """The state of all whole vectors after the first, complete assignment."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, x = whole_vectors(batch.column(1), scale, dim)
        packed = x.astype(np.int32)
        columns = [batch.column(0).filter(pa.array(keep)), pa.array([r.tobytes() for r in packed], pa.binary()), *map(pa.array, scan(x, centroids))]
        return pa.record_batch(columns, ["vec_id", "v", "cluster", "upper", "lower"])

    return by_batch(vectors, kernel, STATE)


def _reassigned(state: DataFrame, dim: int, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        cluster, upper, lower, _ = reassign(_vectors(batch.column(1), dim), *(batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4)), centroids, drift)
        return pa.record_batch([batch.column(0), batch.column(1), *map(pa.array, (cluster, upper, lower))], ["vec_id", "v", "cluster", "upper", "lower"])

    return by_batch(state, kernel, STATE)


def _moved(state: DataFrame, dim: int, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one update: floor(sum / count) of each cluster's vectors; one without any stays where it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centroids), dim + 1), np.int64)  # the last column counts
        for batch in batches:
            x = _vectors(batch.column(0), dim)
            summed_by(batch.column(1).to_numpy(), np.column_stack([x, np.ones(len(x), np.int64)]), sums)
        held = np.flatnonzero(sums[:, dim])
        yield pa.record_batch([pa.array(held), pa.array(list(sums[held]), pa.list_(pa.int64()))], ["cluster", "sums"])

    partial = state.select("v", "cluster").mapInArrow(run, "cluster long, sums array<long>")
    out = centroids.copy()
    for r in partial.groupBy("cluster").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(dim + 1)]).alias("sums")).collect():
        out[r.cluster] = np.array(r.sums[:dim], np.int64) // r.sums[dim]
    return out


def centroid_clusters(vectors: DataFrame, dim: int = 64, scale: int = 64, clusters: int = 16, rounds: int = 3, seed: int = 1) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) for each row of vectors(vec_id, embedding) that is kept.

    Kept are vectors of dim components, none null or not finite; each component x becomes floor(scale * x). Centroids
    start as the kept vectors with the least sha256 of "seed:vec_id"; fewer kept vectors make fewer clusters. Each round
    assigns all vectors to their nearest centroid and moves the centroids; then vectors are assigned once more. All of it
    is exact: bounds are rounded away from the values they bound, and decide only where they can't be wrong.

    Each vector is written with its upper and lower bound once a round, and read by its own task in the next one: no
    vector is shuffled. What is shuffled and comes to the driver is one sum of vectors a cluster (from each task), so a
    cluster that holds most vectors costs no more than others.

    Ties go to the smaller cluster number. Repeated rows and rows without vec_id are vectors of their own (the latter
    start no centroid while others can; of one vec_id's vectors the lesser one comes first). An empty table, or one
    without a kept vector, gives an empty result. Other columns are ignored. A component of LIMIT or more, once scaled, is
    an error.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long"), F.col("embedding"))
    centroids = _starts(vectors, dim, scale, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    state = cut(_assigned(vectors, dim, scale, centroids))
    for k in range(rounds):
        moved = _moved(state, dim, centroids)
        drift, centroids = _raised(np.sqrt(((moved - centroids) ** 2).sum(axis=1))), moved
        state = _reassigned(state, dim, centroids, drift)
        if k + 1 < rounds:
            state = cut(state)
            release(spark)  # of the state before

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        distance = own_squares(_vectors(batch.column(1), dim), batch.column(2).to_numpy(), centroids)
        return pa.record_batch([batch.column(0), batch.column(2), pa.array(distance)], ["vec_id", "cluster", "distance"])

    found = cut(by_batch(state.select("vec_id", "v", "cluster"), kernel, "vec_id long, cluster int, distance long"))
    inertia = {r.cluster: r.n for r in found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    rows = [(k, n, sum(inertia.values()), centroids[k].tolist()) for k, n in inertia.items()]
    of_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def _oracle(dim: int = 64, scale: int = 64, clusters: int = 16, rounds: int = 3, seed: int = 1) -> str:
    square = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    steps = [f"""
kept as materialized (select vec_id, list_transform(embedding, lambda e: floor({scale} * e::double)::bigint) as x from embeddings
  where len(embedding) = {dim} and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = {dim}),
c0 as materialized (select row_number() over (order by sha256('{seed}:' || vec_id)) - 1 as k, x from kept order by sha256('{seed}:' || vec_id) limit {clusters})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (select vec_id, x, d[1] as distance, d[2] as k from (
  select v.vec_id, any_value(v.x) as x, min([{square}, c.k]) as d from kept v cross join c{r} c group by v.vec_id))""")
        if r < rounds:
            steps.append(f"""
s{r} as materialized (select k, i, sum(e)::hugeint as total, count(*)::hugeint as n
  from (select k, unnest(x) as e, generate_subscripts(x, 1) as i from a{r}) group by k, i),
c{r + 1} as materialized (select c.k, coalesce(m.x, c.x) as x from c{r} c left join (
  select k, list((total // n - case when total % n < 0 then 1 else 0 end)::bigint order by i) as x from s{r} group by k) m on c.k = m.k)""")
    return f"""with {",".join(steps)}
select vec_id, a.k::int as cluster, distance, sum(distance) over (partition by a.k)::bigint as cluster_inertia,
  sum(distance) over ()::bigint as inertia, sha256(array_to_string(c.x, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c on a.k = c.k"""


ORACLE = _oracle()


def digest(numbers: list[int]) -> str:
    """What a centroid or codebook is told by: sha256 of its decimal numbers, comma-joined."""
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
