"""Names within a small edit distance of each other, without comparing all with all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A segment that more names than this hold is too common to compare all its names; they meet by what is left of them
#: after deletions instead.
CROWD = 64
KEY = ["len", "i", "segment"]


def _bounds(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Where the i-th of so many parts of a name begins, and its length."""
    begin, end = (F.floor(length * k / parts).cast("int") for k in (i, i + 1))
    return begin, end - begin


def _own_segments(name: Column, most: int) -> Column:
    """A name cut into most + 1 segments, each with its number and the name's length."""
    n, parts = F.length(name), most + 1
    cut = [(i, *_bounds(n, i, parts)) for i in range(parts)]
    return F.array(*[F.struct(n.alias("len"), F.lit(i).alias("i"), F.substring(name, begin + 1, size).alias("segment")) for i, begin, size in cut])


def _other_segments(name: Column, most: int) -> Column:
    """Where the segments of a name that is at most so much shorter could stand in this one.

    If a segment that begins at p in the other name is at p + x here, and the other is shorter by d, then at least |x|
    edits lie before it and |d - x| behind it: x goes from -(most - d) // 2 to (most + d) // 2.
    """
    n, out = F.length(name), []
    for shorter in range(most + 1):
        for i in range(most + 1):
            begin, size = _bounds(n - shorter, i, most + 1)
            for x in range(-((most - shorter) // 2), (most + shorter) // 2 + 1):
                at = begin + x
                fits = (n >= shorter) & (at >= 0) & (at + size <= n)
                out.append(F.when(fits, F.struct((n - shorter).alias("len"), F.lit(i).alias("i"), F.substring(name, at + 1, size).alias("segment"))))
    return F.array_distinct(F.array_compact(F.array(*out)))


def deletions(name: Column, most: int) -> Column:
    """A name, and all that is left of it after up to so many deletions; two names within that edit distance share one."""

    def after(x: Column, first: Column, left: int) -> Column:
        if left == 0:
            return F.array(x)
        places = F.when(first <= F.length(x), F.sequence(first, F.length(x))).otherwise(F.array().cast("array<int>"))
        without = lambda i: F.concat(F.substr(x, F.lit(1), i - 1), F.substr(x, i + 1))
        return F.concat(F.array(x), F.flatten(F.transform(places, lambda i: after(without(i), i, left - 1))))

    return F.array_distinct(after(name, F.lit(1), most))


def edit_links(names: DataFrame, most: int = 2, crowd: int = CROWD) -> DataFrame:
    """(a, b, distance), a < b: all pairs of different values of names(name) within so many edits; null is no name.

    A name is cut into most + 1 segments. Fewer edits than segments leave one of them whole, so each pair meets on a
    segment, at one of few places (_other_segments), and the distance is measured only there. A segment that more than
    crowd names of one length share would make too many pairs: its names meet by equal deletions() instead, which only
    names within twice the distance share. So no pair is lost, and no group of names is compared with itself as a whole.
    """
    distinct = names.select("name").where("name is not null").distinct()
    held = distinct.select(F.explode(_own_segments(F.col("name"), most)).alias("s"), F.col("name").alias("b")).select("s.*", "b")
    asked = distinct.select(F.explode(_other_segments(F.col("name"), most)).alias("s"), F.col("name").alias("a")).select("s.*", "a")
    crowded = held.groupBy(*KEY).agg(F.count("*").alias("n")).where(F.col("n") > crowd).select(*KEY)
    near = lambda pairs: pairs.where("a <> b").withColumn("distance", F.levenshtein("a", "b", most)).where("distance >= 0")
    few = near(held.join(crowded, KEY, "left_anti").join(asked, KEY).select("a", "b"))
    many = [side.join(crowded, KEY, "left_semi").select(F.col(c).alias("name")) for side, c in ((held, "b"), (asked, "a"))]
    left = many[0].unionByName(many[1]).distinct().select("name", F.explode(deletions(F.col("name"), most)).alias("rest"))
    left = left.select("name", F.xxhash64("rest").alias("rest"))
    met = near(left.withColumnRenamed("name", "a").join(left.withColumnRenamed("name", "b"), "rest").where("a < b").select("a", "b"))
    ordered = few.unionByName(met).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance")
    return ordered.distinct()


def link_counts(names: DataFrame, links: DataFrame) -> DataFrame:
    """(name, links, nearest) for each different name: how many others it has a link with, and the least of their distances."""
    ends = links.select(F.explode(F.array("a", "b")).alias("name"), "distance")
    counted = ends.groupBy("name").agg(F.count("*").alias("links"), F.min("distance").alias("nearest"))
    distinct = names.select("name").where("name is not null").distinct()
    return distinct.join(counted, "name", "left").select("name", F.coalesce("links", F.lit(0)).alias("links"), "nearest")
