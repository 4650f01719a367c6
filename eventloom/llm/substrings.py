"""Substring deduplication on a de Bruijn graph of word k-mers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import cut
from eventloom.llm.repeats import Unit, edges, mixed_contents, remove_repeats, repeated_runs


def compacted_paths(rows: DataFrame) -> DataFrame:
    """(content, low, high, path): the repeated edges of rows(content, place, edge, next, before, weight), compacted.

    An edge is a k-mer of words; it is repeated if the corpus holds it at least twice. Where every occurrence of an edge
    is followed by one and the same edge, and every occurrence of that is preceded by the first, the two lie on a
    nonbranching path. The join of the graph with itself finds these links, and the join with the occurrences compacts
    each maximal path to one row for each place where a text walks it. Both aggregate before they shuffle, and no path
    has to be walked step by step: each occurrence walks it whole.
    """
    graph = rows.groupBy("edge").agg(F.sum("weight").alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("next", "before") for f in (F.min, F.max)]).where("n >= 2")
    graph = cut(graph.select("edge", F.when(F.col("min_next") == F.col("max_next"), F.col("min_next")).alias("after"), F.when(F.col("min_before") == F.col("max_before"), F.col("min_before")).alias("ahead")))
    links = graph.select(F.col("edge").alias("before"), F.col("after").alias("edge")).where("edge <> 0").join(graph.select("edge", "ahead"), "edge").where("ahead = before").select("edge", F.lit(True).alias("linked"))
    walked = rows.select("content", "place", "edge").join(graph.select("edge"), "edge").join(links, "edge", "left")
    steps = F.array_sort(F.collect_list(F.struct("place", "edge", F.coalesce("linked", F.lit(False)).alias("linked"))))
    pieces = F.aggregate(
        "steps",
        F.expr("cast(array() as array<struct<low:bigint,high:bigint,path:bigint>>)"),
        lambda done, s: F.when(
            s["linked"] & (F.size(done) > 0) & (F.element_at(done, -1)["high"] == s["place"] - 1),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["low"].alias("low"), s["place"].alias("high"), F.element_at(done, -1)["path"].alias("path")))),
        ).otherwise(F.concat(done, F.array(F.struct(s["place"].alias("low"), s["place"].alias("high"), s["edge"].alias("path"))))),
    )
    return walked.groupBy("content").agg(steps.alias("steps")).select("content", F.explode(pieces).alias("p")).select("content", "p.low", "p.high", "p.path")


def verified(paths: DataFrame, weights: DataFrame) -> DataFrame:
    """The paths that lie, at one length, at two source coordinates or more (a content of weight n stands for n places)."""
    placed = paths.join(weights, "content")
    sound = cut(placed.groupBy("path", (F.col("high") - F.col("low")).alias("length")).agg(F.sum("weight").alias("places")).where("places >= 2").select("path", "length"))
    return placed.withColumn("length", F.col("high") - F.col("low")).join(sound, ["path", "length"], "left_semi").select("content", "low", "high")


def substring_dedup(docs: DataFrame, window: int = 35, anchor: int = 18) -> DataFrame:
    """(doc_id, n_units, n_removed, n_spans, kept_sha256): each row of docs without the words of repeated windows.

    A window is that many consecutive words of a document; a word goes if a window over it has its sequence of words also
    elsewhere, in this document or another. See repeats.py for how the corpus is narrowed down to stretches that may
    repeat; in what remains, windows are the edges of a de Bruijn graph whose nonbranching repeated paths are compacted
    and verified at their source coordinates. Windows are compared by 64-bit hashes.

    A null or empty text has no words; null doc_ids and repeated rows stay, and the latter are each other's copies; an
    empty table gives an empty result; other columns are ignored.
    """
    unit = Unit(True, window, anchor)

    def resolve(texts: DataFrame, segments: DataFrame) -> DataFrame:
        rows = cut(mixed_contents(texts, segments, unit, *edges(unit)))
        weights = rows.where("place = 0").select("content", "weight")
        return repeated_runs(verified(compacted_paths(rows), weights))

    return remove_repeats(docs, unit, resolve)
