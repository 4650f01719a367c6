"""Tasks stay as large as they are when tables grow, and when a key has very many rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import retrieval, spread
from eventloom.plans import coding
from eventloom.plans.queries_sources import e1_code_events
from eventloom.sources import sinks
from __spark_entry__ import SMOKE_DIR

FIELDS = [retrieval.Field("title", 50, exact=250), retrieval.Field("intro_para", 5)]


def _sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


def test_spread_join(spark, monkeypatch):
    monkeypatch.setattr(spread, "COMMON", 20)
    many = spark.range(1000).select("id", F.when(F.col("id") < 900, "a").when(F.col("id") < 960, "unheld").otherwise(F.col("id").cast("string")).alias("key"))
    few = spark.createDataFrame([("a", 1), ("a", 2), ("970", 3), ("none", 4)], "key string, use int")
    sizes = many.groupBy("key").agg(F.count("*").alias("n"))
    for how in ("inner", "left"):
        plain = sorted(map(tuple, many.join(few, "key", how).select("id", "key", "use").collect()), key=str)
        met = spread.spread_join(many, few, ["key"], F.col("id"), sizes, how, 16)
        assert sorted(map(tuple, met.select("id", "key", "use").collect()), key=str) == plain
        assert max(_sizes(met)) < 600 < len(plain)  # one task had all rows of "a"


def test_common_words(spark, tmp_path, monkeypatch):
    """A word of every article is searched by several tasks; results are the same."""
    articles = spark.range(300).select(F.concat(F.lit("Lord"), F.col("id").cast("string")).alias("article_id"), F.concat(F.lit("Lord"), F.col("id").cast("string")).alias("title"), F.concat(F.lit("holds land"), F.repeat(F.lit(" land"), (F.col("id") % 5).cast("int"))).alias("intro_para"))
    retrieval.write_index(retrieval.build_index(articles, FIELDS), f"{tmp_path}/index")
    index = retrieval.read_index(spark, f"{tmp_path}/index")
    queries = spark.createDataFrame([(1, "lord7 land"), (2, "lord8"), (3, "land holds"), (4, "nothing")], "query_id int, query string")
    hits = lambda: sorted(tuple(r) for r in retrieval.search(queries, index, FIELDS, 20).select("query_id", "article_id", F.round("score", 6), "rank").collect())
    plain = hits()
    monkeypatch.setattr(spread, "COMMON", 40)
    assert hits() == plain and len(plain) == 41


def test_index_tasks(spark, monkeypatch):
    articles = spark.range(400).select(F.col("id").alias("article_id"), F.concat(F.lit("Lord"), F.col("id").cast("string")).alias("title"), F.lit("holds land").alias("intro_para"))
    assert spread.tasks(spark, 0, 10) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(retrieval, "WORDS", 20)
    assert len(_sizes(retrieval.build_index(articles, FIELDS).postings)) > 40  # 1,200 words


def test_chain_tasks(spark, monkeypatch):
    """Events are dealt to tasks by their number, whatever the number of Spark's shuffle partitions."""
    plain = e1_code_events(spark, SMOKE_DIR)
    monkeypatch.setattr(coding, "ROWS", 50)
    monkeypatch.setattr(spread, "COMMON", 3)
    small = e1_code_events(spark, SMOKE_DIR)
    assert max(_sizes(small)) < 150
    assert small.count() == plain.count() and small.exceptAll(plain).count() == 0


def test_driver_sends_no_growing_table(spark, monkeypatch):
    """Every join of the chain says how it is done, so that none is left to the size of files, except those with a list of roles or countries."""
    plans = []
    note = lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString())
    monkeypatch.setattr(coding, "checkpointed", lambda df, path: note(df) or sinks.checkpointed(df, path))
    note(e1_code_events(spark, SMOKE_DIR))
    joins = [line.strip(" :+-") for plan in plans for line in plan.splitlines() if line.strip(" :+-").startswith("Join ")]
    grown = [j for j in joins if not any(f"({c}#" in j for c in ("query", "phrase", "country"))]  # keys of roles and countries
    open_ = [j for j in grown if "Hint=(strategy=" not in j and not j.startswith("Join FullOuter")]  # a full outer join always shuffles
    assert len(grown) > 10 and not open_
