"""Search by bounds against the plain search, and items in texts against all pairs."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from eventloom.operators import pairs, retrieval
from eventloom.operators.retrieval import Field
from eventloom.plans.registry import scratch
from eventloom.sources.sinks import checkpointed

FIELDS = [Field("title", 50, exact=250), Field("redirects", 50, exact=100, boolean=True, array=True), Field("intro_para", 5)]
SCHEMA = "article_id long, title string, redirects array<string>, intro_para string"


def keep(df):
    return checkpointed(df, scratch(df.sparkSession))


def written(spark, articles):
    path = f"{scratch(spark)}/{uuid.uuid4().hex}"
    retrieval.write_index(retrieval.build_index(articles, FIELDS), path)
    return retrieval.read_index(spark, path)


@pytest.fixture(scope="module")
def corpus(spark):
    """Articles in which one word is everywhere, some are frequent and most are rare; copies make equal scores."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = []
    for i in range(1500):
        text = " ".join(["the", *rng.choices(words, weights, k=rng.randint(5, 60))])
        rows.append((i, " ".join(rng.choices(words, k=2)), [rng.choice(words[:5])], text))
    rows += [(1500 + i, *rows[i % 7][1:]) for i in range(300)]
    queries = [(k, " ".join(["the", *rng.choices(words, k=rng.randint(0, 6))])) for k in range(40)] + [(100, "the"), (101, "w0"), (102, "unknown"), (103, ""), (104, None), (105, rows[0][3])]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(queries, "query_id long, query string")


def hits(df):
    return sorted((r.query_id, r["rank"], r.article_id, round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("k", [1, 5, 40])
def test_bounds_change_nothing(spark, corpus, k, monkeypatch):
    monkeypatch.setattr(retrieval, "PART", 8)
    articles, queries = corpus
    index = written(spark, articles)
    bonus = articles.select("article_id", (F.col("article_id") % 5 * 3 - 1).cast("double").alias("bonus")).where("article_id % 3 > 0")
    for importance in (None, bonus):
        plain = hits(retrieval.search(queries, index, FIELDS, k, importance=importance))
        assert hits(retrieval.search(queries, index, FIELDS, k, importance=importance, keep=keep, few=0)) == plain
        assert len(plain) > 40 * min(k, 5)
    for limit in ("MOST_SEEDS", "MOST_TERMS"):
        monkeypatch.setattr(retrieval, limit, 0)
        assert hits(retrieval.search(queries, index, FIELDS, k, keep=keep, few=0)) == hits(retrieval.search(queries, index, FIELDS, k))
        monkeypatch.undo()


def test_a_word_in_every_article_is_not_shuffled(spark, monkeypatch):
    """Queries of that word and a rarer one shuffle a tenth of the rows, to the same result."""
    rng = random.Random(5)
    rows = [(i, f"t{i}", [], " ".join(["the"] * rng.randint(1, 6) + [f"w{rng.randrange(60)}" for _ in range(rng.randint(3, 30))])) for i in range(6000)]
    index = written(spark, spark.createDataFrame(rows, SCHEMA))
    queries = spark.createDataFrame([(k, f"the t{k * 40} w{k}") for k in range(30)] + [(99, "the")], "query_id long, query string")
    moved, added = [], retrieval._added

    def counted(products):
        moved.append(products.count())
        return added(products)

    monkeypatch.setattr(retrieval, "_added", counted)
    bounded = hits(retrieval.search(queries, index, FIELDS, 3, keep=keep, few=0))
    monkeypatch.undo()
    terms = retrieval._clauses(queries, "query", FIELDS, False).join(index.postings, ["field", "token"])
    assert 10 * sum(moved) < terms.count()
    assert bounded == hits(retrieval.search(queries, index, FIELDS, 3))


def test_no_articles_and_no_queries(spark, corpus):
    articles, queries = corpus
    assert retrieval.search(queries, written(spark, articles.where("false")), FIELDS, 3, keep=keep, few=-1).count() == 0
    assert retrieval.search(queries.where("false"), written(spark, articles), FIELDS, 3, keep=keep, few=-1).count() == 0


def test_items_in_texts(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "bb", "ccc", "", "é", "x\ny"])
    texts = [(i, " ".join(word() for _ in range(rng.randint(0, 30)))) for i in range(60)] + [(99, None)]
    items = [(k, texts[rng.randrange(60)][1][rng.randint(0, 9) :][: rng.randint(0, 30)]) for k in range(60)] + [(98, None)]
    found = pairs.containing(spark.createDataFrame(items, "query_id long, item string"), spark.createDataFrame(texts, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect())) == sorted((k, i) for k, item in items for i, t in texts if item is not None and t is not None and item in t)


def test_articles_are_scored_where_they_are(spark, corpus, monkeypatch):
    """Blocks of a few articles, with a required term and a bonus, give what all products added up give; one query's products aren't shuffled."""
    articles, queries = corpus
    index = written(spark, articles)
    bonus = articles.select("article_id", (F.col("article_id") % 5 * 3 - 1).cast("double").alias("bonus")).where("article_id % 3 > 0")
    required = queries.select("query_id", F.lit("w1 the").alias("term"))
    for rows, products in ((1, 1), (50, 400), (100_000, 2_000_000)):
        monkeypatch.setattr(retrieval, "ROWS", rows)
        monkeypatch.setattr(retrieval, "PRODUCTS", products)
        for most in ({}, {"importance": bonus}, {"required": required, "required_fields": FIELDS}):
            plain = retrieval.search(queries, index, FIELDS, 5, **most)
            there = retrieval.search(queries, index, FIELDS, 5, keep=keep, **most)
            assert hits(there) == hits(plain)
            plan = there._jdf.queryExecution().executedPlan().toString()
            assert "MapInArrow" in plan and "HashAggregate" not in plan


def test_words_are_counted_where_their_article_is(spark, corpus):
    """Articles' texts are shuffled for the index, not their words."""
    index = retrieval.build_index(corpus[0], FIELDS)
    assert "hashpartitioning(field" not in index.postings._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
