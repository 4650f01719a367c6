"""Nearest vectors by an inverted-file index: cells around centroids, of which a query visits few."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a block of a cell, and queries that visit it at once: what one task multiplies.
ROWS_A_BLOCK, QUERIES_A_BLOCK = 8192, 1024
#: Limits of an index: its centroids go with the tasks.
MOST_CELLS, ROWS_A_CELL, SAMPLE = 4096, 64, 50_000
#: Angles of so much less than a bound count as reaching it, as they are rounded.
SLACK = 1e-7


@dataclass(frozen=True)
class VectorIndex:
    """centroids (unit length), reach (the widest angle between a cell's centroid and its vectors), blocks (how many
    each cell's vectors are dealt to), and vectors(cell, block, id, unit)."""

    centroids: np.ndarray
    reach: np.ndarray
    blocks: np.ndarray
    vectors: DataFrame


def _units(column: pa.Array) -> np.ndarray:
    """Vectors of one length, scaled to unit length; all are neither null nor zero."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(embedding: Column) -> Column:
    """Whether a vector has a direction: it isn't null or zero, and all components are finite."""
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(embedding, lambda x: x != 0)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.array(list(rows), pa.list_(pa.float64()))


def _angles(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ centroids.T, -1, 1))


def _by_part(df: DataFrame, kernel: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, rows: int = 1024) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield kernel(batch.slice(at, rows))

    return df.mapInArrow(run, schema)


def _fit(vectors: DataFrame, cells: int, sample: int, seed: int) -> np.ndarray:
    some = vectors.orderBy(F.xxhash64(F.col("id"), F.lit(seed)), "id").limit(sample)
    if cells == 1:
        one = np.array(some.first().embedding, np.float64)
        return (one / np.linalg.norm(one))[None]
    model = KMeans(k=cells, seed=seed, maxIter=10, distanceMeasure="cosine", featuresCol="v").fit(some.select(array_to_vector("embedding").alias("v")))
    found = np.array(model.clusterCenters())
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def build_index(vectors: DataFrame, cells: int | None = None, sample: int = SAMPLE, seed: int = 1, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> VectorIndex:
    """An index of vectors(id, embedding) by the cosine. Vectors without a direction (usable) are left out.

    Centroids are fitted by k-means on at most sample vectors, drawn by a hash of the id; every vector is indexed. There
    are about sqrt(n / ROWS_A_CELL) cells unless told otherwise, at most MOST_CELLS. A cell's vectors are dealt to blocks
    of about ROWS_A_BLOCK, so that a cell that holds a third of all is no task of its own. keep is applied to the assigned
    vectors, which are used more than once: give one that writes and reads them, or caches.
    """
    wanted = vectors.select(F.col("id").cast("long"), F.col("embedding").cast("array<double>")).where(usable(F.col("embedding")))
    if cells is None:
        cells = int(np.clip(np.sqrt(wanted.count() / ROWS_A_CELL), 1, MOST_CELLS))
    if wanted.isEmpty():
        return VectorIndex(np.zeros((0, 0)), np.zeros(0), np.zeros(0, np.int64), vectors.sparkSession.createDataFrame([], "cell int, block int, id long, unit array<double>"))
    centroids = _fit(wanted, cells, sample, seed)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = _units(batch.column(1))
        angles = _angles(rows, centroids)
        cell = angles.argmin(axis=1)
        return pa.record_batch([pa.array(cell, pa.int32()), batch.column(0), _lists(rows), pa.array(angles[np.arange(len(rows)), cell])], ["cell", "id", "unit", "angle"])

    placed = keep(_by_part(wanted, kernel, "cell int, id long, unit array<double>, angle double"))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("reach")).collect()  # a row a cell
    reach, blocks = np.full(len(centroids), -np.inf), np.zeros(len(centroids), np.int64)
    for r in sizes:
        reach[r.cell], blocks[r.cell] = r.reach, -(-r.n // ROWS_A_BLOCK)
    dealt = F.get(F.lit(blocks.tolist()), F.col("cell"))
    return VectorIndex(centroids, reach, blocks, placed.select("cell", F.pmod(F.xxhash64("id"), dealt).cast("int").alias("block"), "id", "unit"))


def _visits(queries: DataFrame, index: VectorIndex, chosen: Callable[[np.ndarray, pa.RecordBatch], np.ndarray], *more: str) -> DataFrame:
    """(query_id, unit, cell) for each of the cells that chosen marks for a query, from its angles with all centroids."""
    centroids = index.centroids

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = _units(batch.column(1))
        query, cell = np.nonzero(chosen(_angles(rows, centroids), batch))
        return pa.record_batch([batch.column(0).take(pa.array(query)), _lists(rows[query]), pa.array(cell, pa.int32())], ["query_id", "unit", "cell"])

    return _by_part(queries.select("query_id", "embedding", *more), kernel, "query_id long, unit array<double>, cell int", rows=256)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores of a row, of equal ones the least ids first."""
    if len(scores) > k:
        least = -np.partition(-scores, k - 1)[k - 1]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def _met(visits: DataFrame, index: VectorIndex, k: int, least: float) -> DataFrame:
    """(query_id, id, similarity): each query's k best vectors of each block it visits, of at least that cosine."""
    asked = {r.cell: r.n for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row a cell
    parts = np.array([-(-asked.get(c, 0) // QUERIES_A_BLOCK) for c in range(len(index.centroids))])
    number = lambda counts: F.get(F.lit(counts.tolist()), F.col("cell")).cast("int")
    key = ["cell", "block", "part"]
    left = visits.withColumn("part", F.pmod(F.xxhash64("query_id"), number(parts)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), number(index.blocks) - 1)))
    right = index.vectors.where(number(parts) > 0).withColumn("part", F.explode(F.sequence(F.lit(0), number(parts) - 1)))

    def score(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out = ([], [], [])
        if len(queries) and len(vectors):
            ids = vectors["id"].to_numpy()
            known = _units(vectors["unit"].combine_chunks())
            asked = _units(queries["unit"].combine_chunks())
            for at in range(0, len(asked), 256):
                for query, scores in zip(queries["query_id"][at : at + 256].to_pylist(), asked[at : at + 256] @ known.T):
                    best = _best(ids, scores, k)
                    best = best[scores[best] >= least]
                    for column, values in zip(out, ([query] * len(best), ids[best], scores[best])):
                        column.extend(values)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "id", "similarity"])

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(score, "query_id long, id long, similarity double")


def _ranked(met: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def nearest(queries: DataFrame, index: VectorIndex, k: int = 10, probes: int = 4, exact: bool = False, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(query_id, id, similarity, rank): the k vectors of the highest cosine with each of queries(query_id, embedding).

    A query visits the probes cells whose centroids are nearest to it, and what it finds there may miss some. With exact
    it then visits all other cells that could hold a better vector than its k-th: those whose reach comes nearer to it than
    that one (the angle between two vectors is at least the difference of their angles with a third). Equal similarities
    rank by id; a query without a direction finds nothing. Tasks get a block of vectors and a block of queries.
    """
    wanted = queries.select(F.col("query_id").cast("long"), F.col("embedding").cast("array<double>")).where(usable(F.col("embedding")))
    if not len(index.centroids):
        return wanted.select("query_id", F.lit(None).cast("long").alias("id"), F.lit(None).cast("double").alias("similarity"), F.lit(None).cast("int").alias("rank")).where("false")

    filled, reach = index.blocks > 0, index.reach

    def first(angles: np.ndarray, _: pa.RecordBatch) -> np.ndarray:
        marked = np.zeros(angles.shape, bool)
        np.put_along_axis(marked, np.argsort(angles, axis=1, kind="stable")[:, :probes], True, axis=1)
        return marked & filled

    found = _ranked(_met(keep(_visits(wanted, index, first)), index, k, -2.0), k)
    if not exact:
        return found
    found = keep(found)
    limits = found.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("similarity")).otherwise(-1.0).alias("least"))

    def others(angles: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        widest = np.arccos(np.clip(batch.column(2).to_numpy(zero_copy_only=False), -1, 1))[:, None]
        return (angles - reach <= widest + SLACK) & ~first(angles, batch)

    open_ = wanted.join(limits, "query_id", "left").fillna({"least": -1.0})
    more = _met(keep(_visits(open_, index, others, "least")), index, k, -2.0)
    return _ranked(found.drop("rank").unionByName(more), k)


def within(queries: DataFrame, index: VectorIndex, threshold: float, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(query_id, id, similarity): the vector of the highest cosine for each query, if it reaches the threshold; exact.

    A query visits every cell that could hold a vector within the threshold's angle, and no other.
    """
    wanted = queries.select(F.col("query_id").cast("long"), F.col("embedding").cast("array<double>")).where(usable(F.col("embedding")))
    if not len(index.centroids):
        return wanted.select("query_id", F.lit(None).cast("long").alias("id"), F.lit(None).cast("double").alias("similarity")).where("false")
    widest, filled, reach = float(np.arccos(np.clip(threshold, -1, 1))), index.blocks > 0, index.reach
    visits = keep(_visits(wanted, index, lambda angles, _: (angles - reach <= widest + SLACK) & filled))
    return _ranked(_met(visits, index, 1, threshold), 1).drop("rank")
