"""Building the knowledge base from dump pages: redirects, admission filters and article fields."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.markup import read_pages
from eventloom.functions.text import clean_names, split_list

_REDIRECT = r"(?i)^\s*#redirect"


def redirect_target(text: Column) -> Column:
    """The first link of a redirect page, or null."""
    return F.when(text.rlike(_REDIRECT), F.nullif(F.regexp_extract(text, r"\[\[(.+?)\]\]", 1), F.lit("")))


def invert_redirects(pages: DataFrame) -> DataFrame:
    """(target, redirects): the titles that redirect to each target, each once, sorted; pairs are made distinct before they are gathered."""
    pairs = pages.select(redirect_target(F.col("text")).alias("target"), "title").where("target is not null").distinct()
    return pairs.groupBy("target").agg(F.array_sort(F.collect_list("title")).alias("redirects"))


def merge_cases(redirects: DataFrame) -> DataFrame:
    """redirects in which a target whose lower-case form is a target too takes that one's titles, and the lower-case one goes."""
    lower = redirects.select(F.col("target").alias("low"), F.col("redirects").alias("more"))
    cased = redirects.where("target <> lower(target)").withColumn("low", F.lower("target"))
    absorbed = cased.select("low").join(lower.select("low"), "low", "left_semi").distinct()
    merged = redirects.withColumn("low", F.when(F.col("target") != F.lower("target"), F.lower("target"))).join(lower, "low", "left")
    kept = merged.join(absorbed.withColumnRenamed("low", "target"), "target", "left_anti")
    return kept.select("target", F.array_sort(F.array_distinct(F.concat("redirects", F.coalesce("more", F.filter("redirects", lambda _: F.lit(False)))))).alias("redirects"))


#: Fixed domain values: what a title of no article of its own holds, in the order of the checks, and where: at its start,
#: at its end, or anywhere.
UNWANTED_TITLES = [
    ("end", ".jpg"),
    ("end", ".png"),
    ("anywhere", "-stub"),
    ("start", "User"),
    ("start", "Selected anniversaries"),
    ("anywhere", "(Disambiguation)"),
    ("anywhere", "(disambiguation)"),
    ("anywhere", "Articles for deletion"),
    ("start", "List "),
    ("start", "Portal "),
    ("anywhere", "Today's featured article"),
    ("anywhere", "Featured article candidates"),
    ("start", "Peer review/"),
    ("start", "Requests for adminship/"),
    ("start", "Featured list candidates/"),
    ("start", "Sockpuppet investigations/"),
]
#: Fixed domain values: what an introduction of no article of its own holds, in the order of the checks, and where: at its
#: start, anywhere, or among so many first characters.
UNWANTED_INTROS = [
    ("start", "REDIRECT"),
    ("start", "#REDIRECT"),
    ("start", "redirect"),
    ("start", "#redirect"),
    ("start", "Redirect"),
    ("start", "#Redirect"),
    ("anywhere", "Category:"),
    ("start", "<noinclude>"),
    (100, "may refer to"),
    (100, "most often refers"),
    (100, "most commonly refers"),
    (100, "Portal:"),
    (100, "portal:"),
]


def holds_any(text: Column, unwanted: list[tuple[str | int, str]]) -> Column:
    """Whether text holds one of the phrases at the place given beside it."""
    at = {"start": F.startswith, "end": F.endswith, "anywhere": F.contains}
    hits = [at[where](text, F.lit(phrase)) if where in at else F.contains(F.substring(text, 1, where), F.lit(phrase)) for where, phrase in unwanted]
    return reduce(lambda a, b: a | b, hits)


def admissible_title(title: Column) -> Column:
    """Whether a page can be an article: no file, stub, user or maintenance page, list, portal or discussion."""
    return F.coalesce((title != "") & ~holds_any(title, UNWANTED_TITLES), F.lit(False))


def admissible_intro(intro: Column) -> Column:
    """Whether an introduction belongs to an article of its own: no redirect, category or list of meanings."""
    return F.coalesce((F.trim(intro) != "") & ~holds_any(intro, UNWANTED_INTROS), F.lit(False))


def attach_redirects(articles: DataFrame, redirects: DataFrame) -> DataFrame:
    """articles with redirects by title; an article without any has an empty list."""
    joined = articles.join(redirects.withColumnRenamed("target", "title"), "title", "left")
    return joined.withColumn("redirects", F.coalesce("redirects", F.expr("cast(array() as array<string>)")))


def latest_by_title(articles: DataFrame) -> DataFrame:
    """One row per title, the one that comes last in order; the whole row is carried through one aggregation."""
    row = F.struct(*articles.columns)
    return articles.groupBy("title").agg(F.max_by(row, "ordinal").alias("row")).select("row.*")


_NAME_KEYS = ["name", "native_name", "other_name", "alias", "birth_name", "nickname", "other_names"]
_PEOPLE_KEYS = ["leaders", "founded_by", "founder"]


def _listed(infobox: Column, keys: list[str]) -> Column:
    return F.flatten(F.transform(F.array(*map(F.lit, keys)), lambda k: F.coalesce(split_list(F.try_element_at(infobox, k)), F.expr("cast(array() as array<string>)"))))


def alternative_names(bold: Column, infobox: Column) -> Column:
    """Names in bold and in the infobox's name fields, cleaned."""
    return clean_names(F.concat(bold, _listed(infobox, _NAME_KEYS)))


def affiliated_people(infobox: Column) -> Column:
    return clean_names(_listed(infobox, _PEOPLE_KEYS))


def without_key(infobox: Column, key: str = "map") -> Column:
    return F.map_filter(infobox, lambda k, _: k != key)


def entry_names(title: Column, redirects: Column, alternatives: Column, infobox: Column) -> Column:
    """All names of an article: its title, redirects, alternatives, and its infobox name alone and with its titles and offices."""
    get = lambda k: F.try_element_at(infobox, F.lit(k))
    name = get("name")
    before = [F.concat_ws(" ", get(k), name) for k in ("prefix", "office", "office1", "rank")]
    shown = F.array(name, *[F.when(get(k).isNotNull(), v) for k, v in zip(("prefix", "office", "office1", "rank"), before)], F.when(get("suffix").isNotNull(), F.concat_ws(" ", name, get("suffix"))))
    empty = F.expr("cast(array() as array<string>)")
    return F.array_distinct(F.array_compact(F.concat(F.array(title), F.coalesce(redirects, empty), F.coalesce(alternatives, empty), F.when(name.isNotNull(), shown).otherwise(empty))))


def parse_markup(pages: DataFrame) -> DataFrame:
    """(title, short_desc, bold, box_type, infobox, categories, intro_para) of wiki markup in pages(title, text).

    Brackets nest, so templates, tables and picture links are found by their depth, for a whole Arrow batch at once
    (functions.markup); a bracket without its partner is text. A page without an infobox has a null box_type.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, fields, intros = read_pages(batch.column(1))
            boxes = pa.array(fields, pa.map_(pa.string(), pa.string()))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(kinds, pa.string()), boxes, intros], ["title", "text", "box_type", "infobox", "intro"])

    intro = F.col("intro")
    scanned = pages.select("title", "text").mapInArrow(run, "title string, text string, box_type string, infobox map<string,string>, intro string")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(intro, r"(?s)<ref[^>/]*>.*?</ref>|<[^>]+>", ""), r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", "$1"), "'{2,}", "")
    return scanned.select(
        "title",
        F.nullif(F.trim(F.regexp_extract("text", r"(?i)\{\{short description\|([^}|]*)", 1)), F.lit("")).alias("short_desc"),
        F.regexp_extract_all(intro, F.lit(r"'''(.+?)'''"), F.lit(1)).alias("bold"),
        "box_type",
        without_key(F.col("infobox")).alias("infobox"),
        F.transform(F.regexp_extract_all("text", F.lit(r"\[\[Category:([^\]|]+)"), F.lit(1)), lambda x: F.trim(x)).alias("categories"),
        F.regexp_replace(bare, r"^\s+|\s+$", "").alias("intro_para"),
    )


def build_knowledge_base(pages: DataFrame) -> DataFrame:
    """Articles from dump pages(title, text): parsed, filtered, with redirects by title.

    Pages to parse are dealt to all tasks first: a small file of many pages is read by a few.
    """
    own = pages.where(admissible_title(F.col("title")) & redirect_target(F.col("text")).isNull())
    own = own.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "title")
    parsed = parse_markup(own).where(admissible_intro(F.col("intro_para")))
    named = parsed.select("title", "short_desc", "intro_para", alternative_names(F.col("bold"), F.col("infobox")).alias("alternative_names"), affiliated_people(F.col("infobox")).alias("affiliated_people"), "box_type", "infobox", "categories")
    return attach_redirects(named, merge_cases(invert_redirects(pages)))
