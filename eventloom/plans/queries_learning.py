"""Pairs, sampling, splits, reports, and trained scorers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import evaluation, learning, pairs, similar_names
from eventloom.plans.registry import query, table

_NAMES_SQL = "(select distinct p_brand as entry, p_name as name from part)"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("entry"), F.col("p_name").alias("name")).distinct()


@query(f"""
with few as (select entry, name from {_NAMES_SQL} qualify row_number() over (partition by entry order by md5('42|' || entry || '|' || name), name) <= 20),
p as (select x.entry, x.name as a, y.name as b from few x join few y on x.entry = y.entry and x.name < y.name)
select entry, a, b from p qualify row_number() over (partition by entry order by md5('43|' || entry || '|' || a || '|' || b), a, b) <= 10""")
def m7_positive_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.positive_pairs(_names(spark, sf_dir), most_names=20, most_pairs=10)


@query(f"""
with f as (select entry, arg_min(name, (md5('42|' || entry || '|' || name), name)) as name, md5('42|' || entry) as d from {_NAMES_SQL} group by entry),
n as (select entry, name, ('0x' || substr(d, 1, 8))::bigint % 4 as bucket, d from f),
o as (select entry, name, coalesce(lead({{'e': entry, 'n': name}}) over (partition by bucket order by d, entry), first({{'e': entry, 'n': name}}) over (partition by bucket order by d, entry rows between unbounded preceding and unbounded following)) as o from n)
select entry, name as a, o.e as other, o.n as b from o where o.e <> entry""")
def m8_random_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.random_negatives(_names(spark, sf_dir), buckets=4)


@query(f"""
with names as {_NAMES_SQL}, hits as (select x.entry, y.entry as other, row_number() over (partition by x.entry order by levenshtein(x.entry, y.entry), y.entry) as rank from (select distinct entry from names) x, (select distinct entry from names) y),
near as (select entry, other from hits where entry <> other qualify row_number() over (partition by entry order by rank) <= 2), mine as (select entry, name as a from names qualify row_number() over (partition by entry order by md5('42|' || entry || '|' || name), name) <= 2)
select near.entry, a, other, names.name as b from near join mine using (entry) join names on names.entry = other""")
def m9_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    names = _names(spark, sf_dir)
    links = similar_names.edit_links(names.select(F.col("entry").alias("name")))  # brands differ in at most two digits
    both = links.select(F.explode(F.array(F.struct(F.col("a").alias("entry"), F.col("b").alias("other")), F.struct(F.col("b").alias("entry"), F.col("a").alias("other")))).alias("p"), "distance").select("p.*", "distance")
    hits = both.withColumn("rank", F.row_number().over(Window.partitionBy("entry").orderBy("distance", "other")))
    return pairs.hard_negatives(names, hits, own=2, nearest=2)


@query("select o_orderkey from orders order by md5('7|' || o_orderkey), o_orderkey limit 100")
def u4_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.sample_rows(table(spark, sf_dir, "orders").select("o_orderkey"), 100, 7, "o_orderkey")


@query("select o_orderkey, case when ('0x' || substr(md5('42|' || o_custkey), 1, 8))::bigint < 3435973836 then 'train' else 'test' end as split from orders")
def m4_grouped_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.grouped_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey").select("o_orderkey", "split")


@query("""
with r as (select quality::varchar as label, (length(text) > 800)::int::varchar as predicted from labels join documents using (doc_id)),
c as (select l.label, (select count(*) from r where label = l.label) as support, (select count(*) from r where predicted = l.label) as predicted, (select count(*) from r where label = l.label and predicted = l.label) as hits from (select label from r union select predicted from r) l)
select label, round(hits / nullif(predicted, 0), 9) as precision, round(hits / nullif(support, 0), 9) as recall, round(2 * hits / nullif(predicted + support, 0), 9) as f1, support from c""")
def a12_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", (F.length("text") > 800).cast("int").cast("string").alias("predicted")), "doc_id")
    report = evaluation.classification_report(rows.select(F.col("quality").cast("string").alias("label"), "predicted"))
    return report.select("label", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"), F.round("f1", 9).alias("f1"), "support")


@query("with v as (select p_brand, sum(p_retailprice) as value from part group by p_brand) select p_brand as feature, round(value / (select sum(value) from v), 9) as share, row_number() over (order by value desc, p_brand)::int as rank from v")
def a14_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    importance = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.sum("p_retailprice").alias("value"))
    return evaluation.balance_shares(importance).select("feature", F.round("share", 9).alias("share"), "rank")


@query("select o_orderpriority, count(distinct o_custkey) as customers, max(o_totalprice) as top, count(*) as orders from orders group by o_orderpriority")
def a8_a13_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = evaluation.group_sizes(table(spark, sf_dir, "orders"), "o_orderpriority", "o_custkey", "o_totalprice")
    return sizes.withColumnsRenamed({"members": "customers", "n": "orders"})


@query()
def m1_m2_event_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trains two event models on the embeddings and scores every vector (no SQL equivalent: iterative optimisation)."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", F.col("label").cast("string").alias("label"), F.lit(0.01).alias("p_event"))
    scored = learning.fit_event_scorer(rows, ["0", "1"]).score(rows)
    return scored.select("id", "label", F.transform("probabilities", lambda p: F.round(p, 4)).alias("probabilities"))


@query()
def m3_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trains the candidate ranker and picks an article for each task (no SQL equivalent: boosted trees)."""
    from eventloom.operators.ranking import choose_by_model
    from eventloom.plans.queries_articles import _scores

    features = ["exact_title_match", "redirect_match", "title_sim", "context_sim_intro", "alt_names_count", "intro_length"]
    scores = _scores(spark, sf_dir).withColumn("correct", ((F.col("exact_title_match") == 1) & (F.col("title_sim") > 0.3)).cast("double"))
    model = learning.fit_ranker(scores, features, trees=5, depth=3)
    ranked = learning.ranker_probability(model, scores)
    return choose_by_model(ranked, F.col("probability")).select("task", "article_id", F.round("probability", 4).alias("probability"))


@query()
def m6_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the ranker without some features, by training size (no SQL equivalent: boosted trees)."""
    from eventloom.plans.queries_articles import _scores

    features = ["exact_title_match", "title_sim", "context_sim_intro", "intro_length"]
    scores = _scores(spark, sf_dir).withColumn("correct", ((F.col("exact_title_match") == 1) & (F.col("title_sim") > 0.3)).cast("double"))
    runs = learning.run_ablations(scores, features, {"all": [], "no title": ["exact_title_match", "title_sim"]}, [100], [1, 2], trees=3, depth=2)
    return spark.createDataFrame([(r["name"], r["size"], r["seed"], r["accuracy"]) for r in runs], "drop_name string, size int, seed int, accuracy double")
