"""Vector compression: each part of a vector becomes the number of the nearest entry of that part's codebook."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import by_batch, cut
from eventloom.llm.integers import is_whole, summed_by, whole_vectors

#: Sums of errors by label are broadcast up to so many labels; with more, both sides are shuffled.
BROADCAST_LABELS = 10_000
#: Parts into which the rows of each label are dealt in that shuffle.
SALTS = 64


class Codebook:
    """Entries of one part, and its nearest entry for rows of that part, exactly."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.singles = entries.astype(np.float32)
        self.squares = (entries**2).sum(axis=1).astype(np.float64)
        self.lengths = np.sqrt(self.squares)
        n = entries.shape[1] + 3  # roundings on the way to a dot product: of both factors, the product, and each sum
        self.rounding = n * 2.0**-24 / (1 - n * 2.0**-24)

    def intervals(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds (lower, upper) on |entry|^2 - 2 x.entry, by which entries can be told for a row, from one product in float32.

        The product is off by at most rounding * sum |x_i| |entry_i|, in whatever order it is summed; that sum is at most
        |x| |entry|. The second term covers the few operations in float64.
        """
        reach = np.sqrt((x**2).sum(axis=1, dtype=np.float64))[:, None] * self.lengths
        score = self.squares - 2 * (x.astype(np.float32) @ self.singles.T).astype(np.float64)
        error = 2.0001 * self.rounding * reach + 2.0**-48 * (self.squares + 2 * reach)
        return score - error, score + error

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry to each row of x; of equally near ones the first.

        Every entry whose interval begins before the least end is measured again in 64-bit integers.
        """
        if not len(x):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lower, upper = self.intervals(x)
        row, entry = np.nonzero(lower <= upper.min(axis=1, keepdims=True))
        exact = ((x[row] - self.entries[entry]) ** 2).sum(axis=1)
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        best = np.minimum.reduceat(exact, starts)
        is_best = np.flatnonzero(exact == best[row])
        first = is_best[np.flatnonzero(np.diff(row[is_best], prepend=-1))]
        return entry[first], best


def _split(x: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(x, parts, axis=1)


def _moved(vectors: DataFrame, scale: int, books: list[Codebook]) -> list[Codebook]:
    """The codebooks after one update: floor(sum / count) of each entry's parts; an entry without any stays as it is."""
    parts, size, width = len(books), len(books[0].entries), books[0].entries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, size, width + 1), np.int64)  # the last column counts
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                _, x = whole_vectors(batch.column(0).slice(at, 1024), scale, parts * width)
                for p, xs in enumerate(_split(x, parts)):
                    summed_by(books[p].nearest(xs)[0], np.column_stack([xs, np.ones(len(xs), np.int64)]), sums[p])
        p, k = np.nonzero(sums[:, :, width])
        yield pa.record_batch([pa.array(p), pa.array(k), pa.array(list(sums[p, k]), pa.list_(pa.int64()))], ["part", "entry", "sums"])

    partial = vectors.select("embedding").mapInArrow(run, "part long, entry long, sums array<long>")
    entries = [b.entries.copy() for b in books]
    for r in partial.groupBy("part", "entry").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width + 1)]).alias("sums")).collect():
        entries[r.part][r.entry] = np.array(r.sums[:width], np.int64) // r.sums[width]
    return [Codebook(e) for e in entries]


def fit_codebooks(vectors: DataFrame, scale: int = 1024, parts: int = 4, entries: int = 256, rounds: int = 4) -> list[Codebook]:
    """Codebooks of each part position, from vectors(vec_id, embedding); none if no vector is kept (compress).

    Entries start as the parts of the kept vectors with the least vec_ids (those without come last; of one vec_id's
    vectors the lesser comes first). Each round reads the vectors where they are and returns one sum an entry and task.
    """
    kept = vectors.where(is_whole("embedding")).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    order = [F.asc_nulls_last("vec_id"), F.col("embedding")]
    first = kept.where(F.size("embedding") > 0).orderBy(*order).first()
    if first is None:
        return []
    dim = len(first.embedding)
    if dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    rows = kept.where(F.size("embedding") == dim).orderBy(*order).limit(entries).collect()
    _, starts = whole_vectors(pa.array([r.embedding for r in rows], pa.list_(pa.float64())), scale, dim)
    books = [Codebook(p) for p in _split(starts, parts)]
    for _ in range(rounds):
        books = _moved(vectors, scale, books)
    return books


def compress(vectors: DataFrame, books: list[Codebook], scale: int = 1024) -> DataFrame:
    """(vec_id, label, codes, error) for each kept row of vectors(vec_id, embedding, label): the entry of each part's
    codebook that is nearest, from 0, and the squared distances to them, summed."""
    dim = sum(b.entries.shape[1] for b in books)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, x = whole_vectors(batch.column(2), scale, dim)
        found = [b.nearest(xs) for b, xs in zip(books, _split(x, len(books)))]
        codes, error = np.column_stack([f[0] for f in found]), np.sum([f[1] for f in found], axis=0)
        kept = [batch.column(k).filter(pa.array(keep)) for k in (0, 1)]
        return pa.record_batch([*kept, pa.array(list(codes.astype(np.int32)), pa.list_(pa.int32())), pa.array(error, pa.int64())], ["vec_id", "label", "codes", "error"])

    label = vectors.schema["label"].dataType.simpleString()
    return by_batch(vectors.select(F.col("vec_id").cast("long"), "label", "embedding"), kernel, f"vec_id long, label {label}, codes array<int>, error long")


def reconstruct(codes: list[int], books: list[Codebook]) -> list[int]:
    """The integer vector that a row's codes stand for."""
    return [int(e) for k, b in zip(codes, books) for e in b.entries[k]]


def vector_codes(vectors: DataFrame, scale: int = 1024, parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, list[Codebook]]:
    """(vec_id, label, codes, error, label_error) for each kept row of vectors(vec_id, embedding, label), and the codebooks.

    Kept are vectors without null or non-finite components whose length is that of the kept vector with the least vec_id:
    one codebook can't code another length, and a length that can't be cut into equal parts is an error. Each component
    x becomes floor(scale * x); one of LIMIT or more is an error. label_error sums the errors of equal labels; nulls are
    one label. No vector is shuffled: a round brings one sum an entry from each task to the driver, 4 x 256 in all.

    Ties go to the lower index; repeated rows and rows without vec_id are vectors of their own; fewer kept vectors than
    entries make a smaller codebook; an empty table, or one without a kept vector, gives an empty result and no codebook;
    other columns are ignored.
    """
    books = fit_codebooks(vectors, scale, parts, entries, rounds)
    label = vectors.schema["label"].dataType.simpleString()
    if not books:
        return vectors.sparkSession.createDataFrame([], f"vec_id long, label {label}, codes array<int>, error long, label_error long"), books
    found = cut(compress(vectors, books, scale))
    sums = cut(found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"))
    columns = ["vec_id", "label", "codes", "error", "label_error"]
    if sums.count() <= BROADCAST_LABELS:
        return found.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of"))).select(*columns), books
    dealt = found.withColumn("salt", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)))
    repeated = sums.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(repeated, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt"))).select(*columns), books


def _oracle(scale: int = 1024, parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    square = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    cut_part = f"x[(p * len(x)) // {parts} + 1 : ((p + 1) * len(x)) // {parts}]"
    steps = [f"""
whole as materialized (select vec_id, label, list_transform(embedding, lambda e: floor({scale} * e::double)::bigint) as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = len(embedding)),
kept as materialized (select vec_id, label, p, {cut_part} as x from whole, range({parts}) t(p)),
c0 as materialized (select p, k, x from (select p, x, row_number() over (partition by p order by vec_id) - 1 as k from kept) where k < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (select vec_id, p, label, x, d[1] as distance, d[2] as k from (
  select v.vec_id, v.p, any_value(v.label) as label, any_value(v.x) as x, min([{square}, c.k]) as d from kept v join c{r} c on v.p = c.p group by v.vec_id, v.p))""")
        if r < rounds:
            steps.append(f"""
s{r} as materialized (select p, k, i, sum(e)::hugeint as total, count(*)::hugeint as n
  from (select p, k, unnest(x) as e, generate_subscripts(x, 1) as i from a{r}) group by p, k, i),
c{r + 1} as materialized (select c.p, c.k, coalesce(m.x, c.x) as x from c{r} c left join (
  select p, k, list((total // n - case when total % n < 0 then 1 else 0 end)::bigint order by i) as x from s{r} group by p, k) m on c.p = m.p and c.k = m.k)""")
    return f"""with {",".join(steps)},
coded as (select vec_id, any_value(label) as label, string_agg(format('{{:02x}}', k), '' order by p) as code, sum(distance)::bigint as error from a{rounds} group by vec_id)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
  (select sha256(string_agg(array_to_string(x, ','), ',' order by p, k)) from c{rounds}) as codebooks_sha256
from coded"""


ORACLE = _oracle()
