"""Names within an edit distance, and nearest vectors, against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.operators import actors, similar_names, vector_index


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def names(seed):
    rng = random.Random(seed)
    made = {"", "a", "b", "ab", "ba", "abc", "é", "éa", "漢字", "漢", "字漢字", "😀a", "aaaaaaaaaa", "aaaaaaaaa", "aaaaaaaa", "aaaaaaa"}
    for stem in ("republic of the north", "republic of the south", "smith", "o'neil", "maria del carmen"):
        for _ in range(25):
            word = list(stem)
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(word) + 1)
                word[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "q", " ", "é"])
            made.add("".join(word))
    return sorted(made)


@pytest.mark.parametrize(("most", "crowd"), [(1, 64), (2, 64), (2, 3), (2, 0), (3, 5)])
def test_all_pairs_within_a_distance(spark, most, crowd):
    known = names(most)
    rows = spark.createDataFrame([(n,) for n in [*known, *known[:5], None]], "name string")
    found = {(r.a, r.b): r.distance for r in similar_names.edit_links(rows, most, crowd).collect()}
    expected = {(a, b): d for a in known for b in known if a.encode() < b.encode() and (d := edits(a, b)) <= most}
    assert found == expected
    counts = {r.name: (r.links, r.nearest) for r in similar_names.link_counts(rows, similar_names.edit_links(rows, most, crowd)).collect()}
    assert set(counts) == set(known)
    for n in known:
        mine = [d for pair, d in expected.items() if n in pair]
        assert counts[n] == (len(mine), min(mine, default=None))


def test_deletions(spark):
    row = spark.createDataFrame([("abca",), ("",)], "x string").select(similar_names.deletions(F.col("x"), 2).alias("d")).collect()
    assert sorted(row[0].d) == sorted({"abca", "bca", "aca", "aba", "abc", "ca", "ba", "bc", "aa", "ac", "ab"}) and row[1].d == [""]


def test_no_nested_loop_and_no_pairs_of_a_crowd(spark):
    """A third of all names share a segment without being near: they aren't compared with each other."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=14))
    rows = spark.createDataFrame([(f"saints of {word()}",) for _ in range(700)] + [(f"{word()}{word()}",) for _ in range(1400)], "name string")
    links = similar_names.edit_links(rows, 2)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert links.count() == 0
    crowd = rows.select(F.explode(similar_names.deletions(F.col("name"), 2)).alias("rest")).groupBy("rest").count()
    assert crowd.agg(F.max("count")).first()[0] <= 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], "name string")
    assert similar_names.edit_links(none).count() == 0 and similar_names.link_counts(none, similar_names.edit_links(none)).count() == 0
    vectors = spark.createDataFrame([], "id long, embedding array<double>")
    index = vector_index.build_index(vectors)
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert vector_index.nearest(asked, index, exact=True).count() == 0 and vector_index.within(asked, index, 0.5).count() == 0


@pytest.fixture(scope="module")
def crowd(spark):
    """Clustered vectors; a third of all are copies of one, so that they tie and share a cell."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[rng.integers(40)] + rng.normal(size=16) * 0.4).tolist()) for i in range(2000)]
    rows += [(2000 + i, rows[0][1]) for i in range(1000)]
    df = spark.createDataFrame([*rows, (9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16)], "id long, embedding array<double>").cache()
    units = np.array([r[1] for r in rows])
    return df, units / np.linalg.norm(units, axis=1, keepdims=True)


def expected(units, query, k):
    scores = np.round(units @ units[query], 9)
    return np.lexsort((np.arange(len(units)), -scores))[:k].tolist()


@pytest.mark.parametrize("exact", [False, True])
def test_nearest(spark, crowd, exact, monkeypatch):
    """Blocks of few rows, so that cells and queries are dealt: recall is at least 0.9 by few probes, and whole if asked for."""
    monkeypatch.setattr(vector_index, "ROWS_A_BLOCK", 100)
    monkeypatch.setattr(vector_index, "QUERIES_A_BLOCK", 7)
    df, units = crowd
    asked = df.where("id % 100 = 0").withColumnRenamed("id", "query_id")
    index = vector_index.build_index(df, cells=30)
    assert index.vectors.groupBy("cell", "block").count().agg(F.max("count")).first()[0] < 200 and index.blocks.max() >= 10
    found = {}
    for r in vector_index.nearest(asked, index, 10, probes=3, exact=exact).collect():
        found.setdefault(r.query_id, {})[r.rank] = r.id
    queries = range(0, 3000, 100)
    hits = sum(len(set(found[q].values()) & set(expected(units, q, 10))) for q in queries)
    assert hits >= 0.9 * 10 * len(queries)
    if exact:
        for q in queries:
            scores = units @ units[q]
            assert np.allclose([scores[found[q][r]] for r in range(1, 11)], np.sort(scores)[::-1][:10], atol=1e-9)


@pytest.mark.parametrize("threshold", [0.5, 0.9, 0.99])
def test_within(spark, crowd, threshold):
    df, units = crowd
    asked = spark.createDataFrame([(i, (units[i] + 0.05).tolist()) for i in range(0, 300, 3)] + [(-1, None), (-2, [0.0] * 16)], "query_id long, embedding array<double>")
    found = {r.query_id: (r.id, r.similarity) for r in vector_index.within(asked, vector_index.build_index(df, cells=20), threshold).collect()}
    for i in range(0, 300, 3):
        q = units[i] + 0.05
        scores = units @ q / np.linalg.norm(q)
        assert (i in found) == (scores.max() >= threshold)
        if i in found:
            assert found[i][1] == pytest.approx(scores.max()) and scores[found[i][0]] == pytest.approx(scores.max())
    assert set(found) <= set(range(0, 300, 3))


def test_a_large_dictionary_of_agents(spark, crowd, monkeypatch):
    """By index or in one pass, each query gets the same agent."""
    df, _ = crowd
    agents = df.where("id < 500").withColumnRenamed("id", "pattern_id")
    queries = df.where("id between 400 and 700").withColumnRenamed("id", "query_id")
    rows = lambda: sorted((r.query_id, r.pattern_id, round(r.conf, 9)) for r in actors.best_agent(queries, agents, 0.9).collect())
    whole = rows()
    monkeypatch.setattr(actors, "AGENTS_A_PASS", 10)
    assert rows() == whole and len(whole) > 100
