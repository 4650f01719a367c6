"""Clustering and compression of vectors against versions that measure every distance."""

import numpy as np
import pytest

from eventloom.llm import clustering, codes
from eventloom.llm.integers import LIMIT, whole_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, code string, v int, part int, h int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "own", "own", 1, 2, 3) for r in rows], SCHEMA)


def odd_rows(n=300, dim=64, seed=1):
    """Vectors in few places, so that many distances tie, beside rows that can't be kept."""
    rng = np.random.default_rng(seed)
    places = rng.integers(-3, 4, (40, dim)) / 8
    rows = [(int(i), (places[rng.integers(40)] + rng.integers(0, 2, dim) / 64).tolist(), int(rng.integers(3)) or None) for i in rng.permutation(n)]
    first = rows[0]
    return [*rows, first, (None, first[1], 1), (n, None, 1), (n + 1, [], 1), (n + 2, [None] * dim, 1), (n + 3, [float("nan")] * dim, 1), (n + 4, [0.0] * (dim - 1) + [float("-inf")], 1), (n + 5, [0.5] * (dim - 4), None)]


def kept(rows, scale, dim=64):
    good = [(r[0], tuple(int(np.floor(scale * x)) for x in r[1]), r[2]) for r in rows if r[1] and len(r[1]) == dim and all(x is not None and np.isfinite(x) for x in r[1])]
    return good


def nearest(x, centres):
    return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centres))


def moved(xs, of, centres):
    out = []
    for k, c in enumerate(centres):
        mine = [x for x, j in zip(xs, of) if j == k]
        out.append(tuple(sum(col) // len(mine) for col in zip(*mine)) if mine else c)
    return out


def test_clusters_of_odd_rows(spark):
    import hashlib

    rows = odd_rows()
    good = kept(rows, 64)
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x, _ in good if i is not None)
    centres, xs = [x for _, x in named[:16]], [x for _, x, _ in good]
    for _ in range(3):
        centres = moved(xs, [nearest(x, centres)[1] for x in xs], centres)
    expected = [(i, nearest(x, centres)) for i, x, _ in good]
    found = clustering.centroid_clusters(table(spark, rows)).collect()
    assert sorted((str(r.vec_id), r.distance, r.cluster) for r in found) == sorted((str(i), d, k) for i, (d, k) in expected)
    assert {(r.cluster, tuple(r.centroid)) for r in found} == {(k, centres[k]) for _, (_, k) in expected}
    assert {r.inertia for r in found} == {sum(d for _, (d, _) in expected)}
    for r in found:
        assert r.cluster_inertia == sum(d for _, (d, k) in expected if k == r.cluster)


def test_bounds_hold_and_spare_scans():
    """After each round every bound holds, the cluster is that of a full scan, and well-separated vectors aren't scanned."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(-40, 40, (400, 64)) + 600 * k for k in range(5)]).astype(np.int64)
    x = np.concatenate([x, rng.integers(-LIMIT + 1, LIMIT, (20, 64))])
    centres = x[rng.permutation(len(x))[:16]]
    cluster, upper, lower = clustering.scan(x, centres)
    spared = 0
    for _ in range(6):
        sums = np.array([x[cluster == k].sum(axis=0) // max((cluster == k).sum(), 1) if (cluster == k).any() else centres[k] for k in range(16)])
        drift, centres = clustering._raised(np.sqrt(((sums - centres) ** 2).sum(axis=1))), sums
        cluster, upper, lower, scanned = clustering.reassign(x, cluster, upper, lower, centres, drift)
        spared += len(x) - scanned
        squares = ((x[:, None].astype(object) - centres[None].astype(object)) ** 2).sum(axis=2)
        assert cluster.tolist() == [min(range(16), key=lambda k: (row[k], k)) for row in squares]
        own = np.array([row[k] for row, k in zip(squares, cluster)], float)
        second = np.array([min(v for j, v in enumerate(row) if j != k) for row, k in zip(squares, cluster)], float)
        assert (upper >= np.sqrt(own) * (1 - 1e-15)).all() and (lower <= np.sqrt(second) * (1 + 1e-15)).all()
    assert spared > len(x)


def test_few_and_no_vectors(spark):
    for rows in ([], [(1, None, 1)], [(1, [0.5] * 63, 1)]):
        assert clustering.centroid_clusters(table(spark, rows)).count() == 0
    assert codes.vector_codes(table(spark, []))[0].count() == 0 and codes.vector_codes(table(spark, [(1, None, 1), (2, [], 1)]))[0].count() == 0
    one = clustering.centroid_clusters(table(spark, [(7, [0.5] * 64, 1), (None, [0.25] * 64, 1)])).collect()
    assert {(r.vec_id, r.cluster, r.distance) for r in one} == {(7, 0, 0), (None, 1, 0)}
    coded = codes.vector_codes(table(spark, [(7, [0.5] * 8, 1), (None, [0.25] * 8, None)]))[0].collect()
    assert {(r.vec_id, tuple(r.codes), r.error, r.label_error) for r in coded} == {(7, (0,) * 4, 0, 0), (None, (1,) * 4, 0, 0)}


def test_too_large_components(spark):
    with pytest.raises(Exception, match="is 134217728 or more"):
        clustering.centroid_clusters(table(spark, [(1, [1e30] * 64, 1)])).count()
    with pytest.raises(ValueError, match="equal parts"):
        codes.vector_codes(table(spark, [(1, [0.5] * 6, 1)]))


def brute_codes(rows, entries, rounds, parts=4):
    good = kept(rows, 1024)
    width = 64 // parts
    cut = lambda x, p: x[p * width : (p + 1) * width]
    starts = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(r[1], p) for r in starts] for p in range(parts)]
    xs = [[cut(r[1], p) for r in good] for p in range(parts)]
    for _ in range(rounds):
        books = [moved(x, [nearest(v, b)[1] for v in x], b) for x, b in zip(xs, books)]
    out = [(r[0], r[2], [nearest(cut(r[1], p), books[p]) for p in range(parts)]) for r in good]
    return [(i, label, tuple(k for _, k in near), sum(d for d, _ in near)) for i, label, near in out], books


@pytest.mark.parametrize("labels", [codes.BROADCAST_LABELS, 0])
def test_codes_of_odd_rows(spark, monkeypatch, labels):
    monkeypatch.setattr(codes, "BROADCAST_LABELS", labels)
    rows = odd_rows(200)
    expected, books = brute_codes(rows, 32, 2)
    found, made = codes.vector_codes(table(spark, rows), entries=32, rounds=2)
    found = found.collect()
    assert [[tuple(e) for e in b.entries.tolist()] for b in made] == books
    assert sorted(((r.vec_id, r.label, tuple(r.codes), r.error) for r in found), key=str) == sorted(expected, key=str)
    for r in found:
        assert r.label_error == sum(e for _, label, _, e in expected if label == r.label)
        assert len(codes.reconstruct(r.codes, made)) == 64


@pytest.mark.parametrize("size", [2, 1000, LIMIT - 1])
def test_screening_loses_nothing(size):
    """Entries that float32 can't tell apart are told by integers, ties by index; the interval holds the exact value."""
    rng = np.random.default_rng(size)
    base = rng.integers(-size, size + 1, (8, 16))
    entries = np.clip(base[rng.integers(8, size=256)] + rng.integers(-1, 2, (256, 16)), -LIMIT + 1, LIMIT - 1)
    x = np.clip(base[rng.integers(8, size=300)] + rng.integers(-2, 3, (300, 16)), -LIMIT + 1, LIMIT - 1)
    book = codes.Codebook(entries)
    squares = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    index, distance = book.nearest(x)
    assert np.array_equal(index, squares.argmin(axis=1)) and np.array_equal(distance, squares.min(axis=1))
    lower, upper = book.intervals(x)
    exact = (entries.astype(object) ** 2).sum(axis=1) - 2 * x.astype(object).dot(entries.T.astype(object))
    assert all(a <= e <= b for a, e, b in zip(lower.flat, exact.flat, upper.flat))


def test_whole_vectors_of_slices():
    import pyarrow as pa

    column = pa.array([[1.0, 2.0], None, [None, 1.0], [-0.01, 0.5], [], [1.0, 2.0, 3.0]], pa.list_(pa.float32()))
    for at in range(4):
        keep, x = whole_vectors(column.slice(at), 10, 2)
        assert keep.tolist() == [True, False, False, True, False, False][at:]
        assert x.tolist() == [[10, 20], [-1, 5]][at > 0 :]
