"""Boilerplate lines: lines that a host repeats on too large a share of its pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import cut


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _line_key(host: Column, line: Column) -> Column:
    """128 bits, as text, that name a line of a host; a null host is a host of its own. Sets of texts are hashed, sets of structs compared one by one."""
    named = F.when(host.isNull(), "").otherwise(F.concat(F.length(host).cast("string"), F.lit(":"), host))
    return F.md5(F.concat(named, F.lit("\n"), line).cast("binary"))


def sorted_contains(keys: Column, key: Column) -> Column:
    """Whether a sorted array holds a key, by binary search; null if the array is null."""
    bit = lambda k: F.call_function("shiftleft", F.lit(1), k)
    widths = F.sequence(F.floor(F.log2(F.greatest(F.size(keys), F.lit(1)).cast("double"))).cast("int"), F.lit(0), F.lit(-1))
    upto = F.aggregate(widths, F.lit(0), lambda n, k: F.when(F.get(keys, n + bit(k) - 1) <= key, n + bit(k)).otherwise(n))
    return F.get(keys, upto - 1).eqNullSafe(key)


def _page_key(host: Column, text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(k), F.isnull(host), host, text).alias(f"page{k}") for k in (1, 2)]


def boilerplate_lines(docs: DataFrame, max_ratio: float, min_pages: int) -> tuple[DataFrame, DataFrame]:
    """Pages (page1, page2, lines) and the lines (l) of docs(text, source) that are boilerplate.

    A page is a different text of a host, so that copies of one page don't make its own lines boilerplate. Only hashes
    are shuffled; counts are combined before each shuffle, so a host with most of the pages is no single task's work.
    """
    host, text = F.col("source"), F.col("text")
    keys = F.array_distinct(F.transform(F.filter(_lines(text), _has_word), lambda x: _line_key(host, x)))
    pages = docs.where("text is not null").select(host, *_page_key(host, text), keys.alias("lines")).groupBy("source", "page1", "page2").agg(F.first("lines").alias("lines"))
    totals = cut(pages.groupBy("source").agg(F.count("*").alias("pages")))
    counts = pages.select("source", F.explode("lines").alias("l")).groupBy("source", "l").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    found = counts.join(totals.withColumnRenamed("source", "host"), F.col("source").eqNullSafe(F.col("host"))).where(F.col("n") > max_ratio * F.col("pages"))
    return pages.select("page1", "page2", "lines"), found.select("l")


def drop_boilerplate(docs: DataFrame, max_ratio: float = 0.1, min_pages: int = 3) -> DataFrame:
    """docs with kept_text, n_lines and n_dropped: the text without lines on more than max_ratio of the host's pages.

    A line is what stands between line feeds; it is boilerplate of its host (source) if at least min_pages of the host's
    different pages, and more than max_ratio of them, hold it. Lines without a word (blank ones) stay. Lost lines are
    looked up by page, so that copies share one answer; the join that brings them to the texts is the only shuffle of
    texts. A null text stays null with 0 lines; null hosts are one host; an empty text has one blank line; repeated rows
    stay; an empty table gives an empty result; other columns are carried along unless they are named like the new ones.
    """
    pages, found = boilerplate_lines(docs, max_ratio, min_pages)
    lost = pages.select("page1", "page2", F.explode("lines").alias("l")).join(found, "l")
    lost = cut(lost.groupBy("page1", "page2").agg(F.array_sort(F.collect_set("l")).alias("lost")))  # cut: a join of plain exchanges can be split where a page has many copies
    host, text = F.col("source"), F.col("text")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")]).alias("row")
    joined = docs.select(row, host, text, *_page_key(host, text)).join(lost, ["page1", "page2"], "left")
    keyed = F.transform(_lines(text), lambda x: F.struct(x.alias("line"), F.when(_has_word(x), _line_key(host, x)).alias("key")))
    kept = F.transform(F.filter(keyed, lambda x: ~F.coalesce(x["key"].isNotNull() & sorted_contains(F.col("lost"), x["key"]), F.lit(False))), lambda x: x["line"])
    shortened = joined.withColumn("kept", F.when(F.col("lost").isNotNull(), kept))
    n = F.coalesce(F.size(_lines(text)), F.lit(0))
    return shortened.select(
        "row.*",
        F.when(F.col("lost").isNull(), text).otherwise(F.array_join("kept", "\n")).alias("kept_text"),
        F.when(text.isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
        F.when(F.col("lost").isNull() | text.isNull(), 0).otherwise(n - F.size("kept")).cast("long").alias("n_dropped"),
    )


ORACLE = r"""
with pages as (select distinct source, text from documents where text is not null),
lines as (select distinct source, text, unnest(string_split(text, chr(10))) as line from pages),
totals as (select source, count(*) as pages from pages group by source),
lost as (
  select l.source, l.line from lines l join totals t on l.source is not distinct from t.source
  where regexp_matches(l.line, '[^\x20\x09-\x0D]')
  group by l.source, l.line, t.pages having count(*) >= 3 and count(*) > 0.1 * t.pages),
of_page as (
  select l.source, l.text, list(l.line) as lost from lines l
  join lost d on l.source is not distinct from d.source and l.line = d.line group by l.source, l.text),
kept as (
  select d.doc_id, d.text, string_split(d.text, chr(10)) as old,
    list_filter(string_split(d.text, chr(10)), lambda x: not list_contains(coalesce(p.lost, []::varchar[]), x)) as new
  from documents d left join of_page p on d.source is not distinct from p.source and d.text = p.text)
select doc_id, coalesce(len(old), 0)::bigint as n_lines, coalesce(len(old) - len(new), 0)::bigint as n_dropped,
  sha256(array_to_string(new, chr(10))) as kept_sha256
from kept
"""
