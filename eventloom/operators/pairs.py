"""Name pairs to train a similarity encoder: positives within an entry, random and hard negatives; deterministic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(seed: int, *keys: str | Column) -> Column:
    """A repeatable random order: the digest of the seed and the keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]))


def sample_rows(rows: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows drawn by the order of draw(); a sampling operator, so n is the result's size."""
    return rows.orderBy(draw(seed, *keys), *keys).limit(n)


def positive_pairs(names: DataFrame, most_names: int = 50, most_pairs: int = 30, seed: int = 42) -> DataFrame:
    """(entry, a, b): drawn pairs of different names of an entry of names(entry, name).

    Of each entry the most_names first drawn names pair up, a before b, and most_pairs of the pairs stay; both bounds
    are the operator's parameters, so an entry with many names makes no more work than most_names squared.
    """
    drawn = Window.partitionBy("entry").orderBy(draw(seed, "entry", "name"), "name")
    few = names.distinct().withColumn("_k", F.row_number().over(drawn)).where(F.col("_k") <= most_names)
    listed = few.groupBy("entry").agg(F.array_sort(F.collect_list("name")).alias("names"))
    pairs = listed.select("entry", F.posexplode("names").alias("i", "a"), "names").select("entry", "a", F.explode(F.slice("names", F.col("i") + 2, F.size("names"))).alias("b"))
    kept = Window.partitionBy("entry").orderBy(draw(seed + 1, "entry", "a", "b"), "a", "b")
    return pairs.withColumn("_k", F.row_number().over(kept)).where(F.col("_k") <= most_pairs).drop("_k")


def random_negatives(names: DataFrame, buckets: int = 1024, seed: int = 42) -> DataFrame:
    """(entry, a, other, b): for each entry's first drawn name one of another entry.

    Entries are dealt to buckets by their draw and sorted within; each takes its successor, the last one the first. A
    bucket with one entry gives none, so use fewer buckets than entries.
    """
    first = names.groupBy("entry").agg(F.min(F.struct(draw(seed, "entry", "name").alias("d"), "name")).alias("n")).select("entry", F.col("n.name").alias("name"), draw(seed, "entry").alias("d"))
    dealt = first.withColumn("bucket", F.conv(F.substring("d", 1, 8), 16, 10).cast("long") % buckets)
    around = Window.partitionBy("bucket").orderBy("d", "entry")
    whole = Window.partitionBy("bucket").orderBy("d", "entry").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.coalesce(F.lead(F.struct("entry", "name")).over(around), F.first(F.struct("entry", "name")).over(whole))
    return dealt.withColumn("o", other).where("o.entry <> entry").select("entry", F.col("name").alias("a"), F.col("o.entry").alias("other"), F.col("o.name").alias("b"))


def hard_negatives(names: DataFrame, hits: DataFrame, own: int = 2, nearest: int = 5, seed: int = 42) -> DataFrame:
    """(entry, a, other, b): up to own names of an entry with the names of the nearest entries that a search for it found, itself left out.

    hits(entry, other, rank) are search results, names(entry, name) all names.
    """
    others = Window.partitionBy("entry").orderBy("rank", "other")
    close = hits.where("other <> entry").withColumn("_k", F.row_number().over(others)).where(F.col("_k") <= nearest)
    drawn = Window.partitionBy("entry").orderBy(draw(seed, "entry", "name"), "name")
    mine = names.withColumn("_k", F.row_number().over(drawn)).where(F.col("_k") <= own).select("entry", F.col("name").alias("a"))
    return close.select("entry", "other").join(mine, "entry").join(names.select(F.col("entry").alias("other"), F.col("name").alias("b")), "other").select("entry", "a", "other", "b")


#: Words in a row by which an item and a text that holds it meet.
MEETING = 3


def containing(items: DataFrame, docs: DataFrame) -> DataFrame:
    """(query_id, doc_id): which texts of docs(doc_id, text) hold which of items(query_id, item), character by character.

    An item's words but for its first and last stand in such a text as they are, between spaces. So they meet on the
    item's words from the second on, and only what meets is looked through. An item of fewer words than MEETING + 2 is
    looked for in all texts.
    """
    words = F.split("item", " ")
    inner = items.select("query_id", "item", F.when(F.size(words) >= MEETING + 2, F.xxhash64(F.array_join(F.slice(words, 2, MEETING), " "))).alias("h"))
    split = docs.select("doc_id", "text", F.split("text", " ").alias("w"))
    places = F.when(F.size("w") >= MEETING, F.sequence(F.lit(1), F.size("w") - MEETING + 1))
    runs = split.select("doc_id", F.explode(F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice("w", i, MEETING), " "))))).alias("h"))
    met = runs.join(inner.where("h is not null").select("query_id", "h"), "h").select("query_id", "doc_id").distinct()
    whole = met.join(items, "query_id").join(docs, "doc_id").where(F.contains("text", F.col("item"))).select("query_id", "doc_id")
    short = inner.where("h is null and item is not null")
    return whole if short.isEmpty() else whole.unionByName(short.join(docs, F.contains("text", F.col("item"))).select("query_id", "doc_id"))
