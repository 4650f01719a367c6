"""Choosing one article among retrieved candidates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.text import alternative_hit, exact_title, levenshtein_similarity, redirect_hit, subsequence_similarity


def score_candidates(candidates: DataFrame) -> DataFrame:
    """candidates with match flags, sizes, name similarities and the flags of the best by each.

    candidates has task, rank, query, country, title, redirects, alternative_names, infobox_name, intro_para, short_desc.
    Windows are partitioned by task, a query's candidate list.
    """
    task = Window.partitionBy("task")
    one = candidates.withColumns({
        "exact_title_match": exact_title(F.col("query"), F.col("country"), F.col("title")).cast("int"),
        "redirect_match": redirect_hit(F.col("query"), F.col("country"), F.col("redirects")).cast("int"),
        "alt_name_match": alternative_hit(F.col("query"), F.col("alternative_names"), F.col("infobox_name")).cast("int"),
        "country_match": F.coalesce(F.contains("intro_para", F.col("country")) | F.contains("short_desc", F.col("country")), F.lit(False)).cast("int"),
        "alt_names_count": F.coalesce(F.size("alternative_names"), F.lit(0)),
        "redirect_names_count": F.coalesce(F.size("redirects"), F.lit(0)),
        "intro_length": F.coalesce(F.length("intro_para"), F.lit(0)),
        "num_es_results": F.count("*").over(task),
        "levenshtein": levenshtein_similarity(F.col("query"), F.col("title")),
        "lcs": subsequence_similarity(F.col("query"), F.col("title")),
    })
    best = lambda c: (F.row_number().over(task.orderBy(F.desc(c), "rank")) == 1).cast("int")
    return one.withColumns({"best_lev": best("levenshtein"), "best_subseq": best("lcs")})


def normalise(scores: DataFrame, columns: list[str]) -> DataFrame:
    """scores with column_norm: the share of the task's maximum, null if that is zero."""
    task = Window.partitionBy("task")
    return scores.withColumns({f"{c}_norm": F.try_divide(F.col(c).cast("double"), F.max(c).over(task).cast("double")) for c in columns})


def combined_score() -> Column:
    """The weighted sum that ranks candidates when no rule applies."""
    similarity = F.col("context_sim_intro") + F.col("context_sim_short") + F.col("actor_desc_sim_intro") + F.col("actor_desc_sim_short")
    flags = 10 * F.col("exact_title_match") + 5 * F.col("redirect_match") + 3 * F.col("alt_name_match") + 2 * F.col("country_match")
    return flags + F.col("title_sim") + 2 * similarity + 0.5 * F.log1p("alt_names_count") + 0.1 * F.log1p("intro_length")


def choose_by_rules(scores: DataFrame, min_combined: float = 9.0) -> DataFrame:
    """(task, article_id, wiki_reason): the article that the first applicable rule picks; a task without one is left out.

    One aggregation by task finds each rule's best candidate (a maximum over a struct, ties to the better rank), so no
    candidate list is sorted or gathered. Context rules apply only where has_context is true.
    """
    scored = scores.withColumn("combined_score", combined_score())

    def top(flag: str | None, by: str) -> Column:
        value = F.struct(F.col(by).alias("value"), (-F.col("rank")).alias("order"), F.col("article_id").alias("article_id"))
        return F.max(F.when(F.col(flag) == 1, value) if flag else value)

    kinds = {"exact": "exact_title_match", "redirect": "redirect_match", "alt": "alt_name_match"}
    bests = {f"{k}_{by}": top(flag, by) for k, flag in kinds.items() for by in ("context_sim_intro", "title_sim")}
    counts = {f"n_{k}": F.sum(flag) for k, flag in kinds.items()}
    grouped = scored.groupBy("task").agg(F.max("has_context").alias("context"), top(None, "context_sim_intro").alias("any_context"), top(None, "combined_score").alias("any_combined"), *[v.alias(k) for k, v in (bests | counts).items()])
    over = lambda name, limit: F.col(f"{name}.value") > limit
    context = F.col("context")
    rules = [
        (F.col("n_exact") == 1, "exact_title_sim", "Single exact title match"),
        ((F.col("n_exact") > 1) & context & over("exact_context_sim_intro", 0.5), "exact_context_sim_intro", "Best context match among exact title matches"),
        ((F.col("n_exact") > 1) & over("exact_title_sim", 0.7), "exact_title_sim", "Best title similarity among exact matches"),
        (F.col("n_redirect") == 1, "redirect_title_sim", "Single redirect match"),
        ((F.col("n_redirect") > 1) & context & over("redirect_context_sim_intro", 0.5), "redirect_context_sim_intro", "Best context match among redirect matches"),
        ((F.col("n_redirect") > 1) & over("redirect_title_sim", 0.7), "redirect_title_sim", "Best title similarity among redirect matches"),
        ((F.col("n_alt") > 0) & context & over("alt_context_sim_intro", 0.6), "alt_context_sim_intro", "Best context match among alternative name matches"),
        (context & over("any_context", 0.6), "any_context", "Best overall context match"),
        (over("any_combined", min_combined), "any_combined", "Best overall combined score"),
    ]
    picked = reduce(lambda c, r: c.when(r[0], F.struct(F.col(f"{r[1]}.article_id").alias("article_id"), F.lit(r[2]).alias("reason"))), rules[1:], F.when(rules[0][0], F.struct(F.col(f"{rules[0][1]}.article_id").alias("article_id"), F.lit(rules[0][2]).alias("reason"))))
    return grouped.select("task", picked.alias("p")).where("p is not null").select("task", "p.article_id", F.col("p.reason").alias("wiki_reason"))


def choose_by_model(scores: DataFrame, probability: Column, threshold: float = 0.5) -> DataFrame:
    """(task, article_id, probability): the candidate of the highest probability, if that is over the threshold."""
    best = scores.groupBy("task").agg(F.max(F.struct(probability.alias("p"), (-F.col("rank")).alias("order"), "article_id")).alias("best"))
    return best.where(F.col("best.p") > threshold).select("task", "best.article_id", F.col("best.p").alias("probability"))
