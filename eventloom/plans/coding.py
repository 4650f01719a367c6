"""The whole coding chain: stories, extractor answers, places and knowledge base to coded events."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.dates import in_force, resolve_dates
from eventloom.functions.text import clean_query
from eventloom.operators import actors, events, ranking, retrieval
from eventloom.operators.spread import dealt, shuffled, spread_join, tasks
from eventloom.sources.sinks import checkpointed

#: A task of the chain joins and groups the rows of about so many mentions or events.
ROWS = 100_000


@dataclass(frozen=True)
class Dimensions:
    """Small tables of the chain: country patterns as (regular expression, code) pairs, names by code, role codes by cleaned phrase, and the country patterns for names of categories."""

    patterns: list[tuple[str, str]]
    countries: DataFrame
    roles: DataFrame
    category_patterns: Sequence[tuple[str, str]] = ()


def agent_to_code(mentions: DataFrame, dims: Dimensions, articles: DataFrame | None = None, folder: str | None = None) -> DataFrame:
    """(text, date, code_1, code_2, country, source, wiki, best_reason) for each different mention(text, date).

    The country pattern is taken out of the text, the rest cleaned and looked up among role phrases; what finds no role
    and isn't empty is searched among the articles, where an exact title gives its role and country for the date.
    Mentions are made distinct first, so each text is resolved once for a date. With a folder that all executors share,
    what several branches use is written there once.
    """
    kept = _keeper(folder)
    distinct = mentions.select("text", "date").distinct()
    found = actors.find_country(distinct, dims.patterns).withColumn("query", F.lower(_cleaned("rest"))).withColumn("actor", F.concat_ws("|", "text", "date"))
    found = kept(found)
    n = _tasks(found, folder)
    direct = found.join(dims.roles.select(F.col("pattern").alias("query"), "code_1", "code_2"), "query")
    candidate = lambda df, source, wiki, conf: df.select("actor", F.lit(0).alias("pos"), "code_1", "code_2", "country", F.lit(source).alias("source"), "query", F.lit(conf).alias("conf"), F.lit(None).cast("int").alias("office_num"), wiki.alias("wiki"))
    codes = candidate(direct, "Direct match", F.lit(""), 1.0)
    if articles is not None:
        open_ = found.join(dims.roles.select(F.col("pattern").alias("query")), "query", "left_anti").where("query <> ''")
        linked = kept(query_wiki(open_.select(F.col("actor").alias("query_id"), F.col("rest").alias("query"), "date"), articles, folder=folder, n=n))
        roles = article_roles(linked.select("title", "date"), articles, dims).withColumn("date", F.coalesce("date", F.lit(""))).withColumnRenamed("query", "roles_query")
        coded = dealt(linked.withColumn("date", F.coalesce("date", F.lit(""))), n, "title", "date").join(shuffled(dealt(roles, n, "title", "date")), ["title", "date"])
        codes = codes.unionByName(coded.select(F.col("query_id").alias("actor"), "pos", "code_1", F.lit("").alias("code_2"), "country", "source", F.col("roles_query").alias("query"), F.lit(None).cast("double").alias("conf"), "office_num", F.col("title").alias("wiki")))
    best = actors.clean_best(actors.pick_best_code(kept(codes), found.select("actor", "country"), n))
    return dealt(found.select("actor", "text", "date"), n, "actor").join(shuffled(best), "actor").drop("actor")


def _cleaned(column: str) -> Column:
    return clean_query(F.col(column))


def _keeper(folder: str | None) -> Callable[[DataFrame], DataFrame]:
    return (lambda df: checkpointed(df, folder)) if folder else (lambda df: df)


def _tasks(df: DataFrame, folder: str | None) -> int | None:
    """Tasks for the rows of a table that is written in folder, which are quickly counted; else None, and Spark chooses."""
    return tasks(df.sparkSession, df.count(), ROWS) if folder else None


def query_wiki(queries: DataFrame, articles: DataFrame, k: int = 50, folder: str | None = None, n: int | None = None) -> DataFrame:
    """(query_id, title, date): the article that each of queries(query_id, query, date) names, if one does.

    Each different text is searched once. Of its k best hits that can be actors, the rules of precedence choose
    (ranking.choose_by_rules), over flags and name similarities; similarities that encoders would give count 0 unless
    articles bring them. With n, queries are dealt to so many tasks.
    """
    numbered = articles.where(retrieval.good_article(F.col("title"), F.col("intro_para"))).withColumn("article_id", F.col("title"))
    fields = retrieval.DEFAULT_FIELDS
    texts = _keeper(folder)(queries.select(F.col("query").alias("query_id"), "query").distinct())
    index = retrieval.build_index(numbered, fields)
    if folder:
        path = f"{folder}/index-{uuid.uuid4().hex}"
        retrieval.write_index(index, path)
        index = retrieval.read_index(queries.sparkSession, path)
    hits = retrieval.search(texts, index, fields, k)
    named = hits.withColumnRenamed("query_id", "task").join(shuffled(numbered.select("article_id", "title", "redirects", "alternative_names", "infobox", "intro_para", "short_desc")), "article_id")
    frame = ranking.score_candidates(named.withColumns({"query": F.col("task"), "country": F.lit(None).cast("string"), "infobox_name": F.try_element_at("infobox", F.lit("name"))}))
    outside = {c: F.lit(0.0) for c in ("title_sim", "context_sim_intro", "context_sim_short", "actor_desc_sim_intro", "actor_desc_sim_short")}
    chosen = ranking.choose_by_rules(frame.withColumns(outside).withColumn("has_context", F.lit(False)))
    return dealt(queries, n, "query").join(shuffled(chosen.select(F.col("task").alias("query"), F.col("article_id").alias("title"))), "query").select("query_id", "title", "date")


#: Fixed domain values: what a code of an article comes from, as the rules of precedence name it.
OFFICE, SHORT_DESCRIPTION, BOX_TITLE, BOX_TYPE = "Infobox", "Wiki short description", "Infobox Title", "Infobox Type"
#: What of an article names countries only.
FIRST_SENTENCE, BOX_COUNTRY, CATEGORY = "first sentence", "infobox country", "category"


def article_evidence(articles: DataFrame, dims: Dimensions) -> DataFrame:
    """(title, source, n, text, term_start, term_end, country, phrase, code_1): a row for each place of an article that can speak for a code or a country.

    The places are the first line of the introduction without brackets, the short description, the infobox's country, its
    own title and type, each office and each category, numbered by n within a source. country is the one that the text
    names (in the first line the earliest, in a category after "of" or "in", else the longest), phrase the cleaned rest,
    or for the infobox's title and type the cleaned whole, and code_1 the role of that phrase; each may be null. Nothing
    here depends on a date, so an article is read once, whatever mentions link to it. Absent, null and empty texts give no row.
    """
    none = lambda kind: F.lit(None).cast(kind)
    box = lambda key: F.try_element_at("infobox", F.lit(key))
    part = lambda source, text, n=F.lit(0), start=none("date"), end=none("date"): F.struct(F.lit(source).alias("source"), n.alias("n"), text.alias("text"), start.alias("term_start"), end.alias("term_end"))
    line = F.split(F.trim(F.regexp_replace("intro_para", r"\(.*?\)", "")), "\n")[0]
    single = F.array(part(FIRST_SENTENCE, line), part(SHORT_DESCRIPTION, F.col("short_desc")), part(BOX_COUNTRY, box("country")), part(BOX_TITLE, F.col("box_type")), part(BOX_TYPE, box("type")))
    offices = F.transform(actors.parse_offices(F.col("infobox")), lambda o, i: part(OFFICE, o["office"], i, o["term_start"], o["term_end"]))
    categories = F.transform("categories", lambda c, i: part(CATEGORY, c, i))
    empty = F.array_except(single, single)
    places = F.filter(F.concat(single, F.coalesce(offices, empty), F.coalesce(categories, empty)), lambda p: F.coalesce(p["text"], F.lit("")) != "")
    dealt = articles.repartition(int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions")), "title")  # a small file of many articles is read by a few tasks
    found = dealt.select("title", F.explode(places).alias("p")).select("title", "p.*")
    ways = [(~F.col("source").isin(FIRST_SENTENCE, CATEGORY), dims.patterns, "longest"), (F.col("source") == FIRST_SENTENCE, dims.patterns, "first"), (F.col("source") == CATEGORY, dims.category_patterns, "longest")]
    for k, (mine, patterns, method) in enumerate(ways):  # one plan without branches: each way sees the texts of its sources, and null for others
        read = actors.find_country(found.withColumns({"whole": F.col("text"), "text": F.when(mine, F.col("text"))}), list(patterns), method)
        found = read.withColumnsRenamed({"country": f"country_{k}", "rest": f"rest_{k}"}).withColumn("text", F.col("whole")).drop("whole")
    said = F.when(F.col("source").isin(BOX_TITLE, BOX_TYPE), F.col("text")).when(F.col("source").isin(OFFICE, SHORT_DESCRIPTION), F.col("rest_0"))
    phrased = found.withColumn("said", said).withColumn("phrase", F.nullif(F.lower(_cleaned("said")), F.lit("")))
    roles = dims.roles.select(F.col("pattern").alias("phrase"), "code_1")
    country = F.coalesce("country_0", "country_1", "country_2").alias("country")
    return phrased.join(roles, "phrase", "left").select("title", "source", "n", "text", "term_start", "term_end", country, "phrase", "code_1")


def article_roles(linked: DataFrame, articles: DataFrame, dims: Dimensions) -> DataFrame:
    """(title, date, pos, code_1, country, source, office_num, query) of each different linked(title, date).

    In order: the first office in force at the date that has a role, or a former office of government where none is in
    force; the short description; the infobox's title; its type. Codes without a country take the article's by a vote
    of all its evidence (of equal countries the one named first); an article whose evidence names countries but no role has one empty code.
    query is the phrase that gave the code.
    """
    of_title = article_evidence(articles.join(shuffled(linked.select("title")), "title", "left_semi"), dims)
    row = F.struct("source", "n", "term_start", "term_end", "country", "phrase", "code_1")
    evidence = of_title.groupBy("title").agg(F.array_sort(F.collect_list(row)).alias("rows"))  # an article's own places, a short list
    dated = linked.select("title", "date").distinct().join(shuffled(evidence), "title").withColumn("when", F.try_to_date("date"))
    of = lambda *sources: F.filter("rows", lambda r: r["source"].isin(*sources))
    first = lambda items: F.get(items, F.lit(0))
    countries = lambda items: F.array_compact(F.transform(items, lambda r: r["country"]))
    spoken = F.concat(*[countries(of(s)) for s in (FIRST_SENTENCE, SHORT_DESCRIPTION, BOX_COUNTRY)])
    rows = dated.withColumns({"spoken": spoken, "offices": of(OFFICE)}).withColumn("primary", first(F.col("spoken")))
    rows = rows.withColumn("current", F.filter("offices", lambda o: in_force(o["term_start"], o["term_end"], F.col("when"))))
    only = F.array_distinct(countries(F.col("offices")))
    former_country = F.when((F.size(only) == 1) & F.coalesce(F.col("primary") == first(only), F.lit(True)), first(only)).otherwise(F.col("primary"))
    code = lambda pos, role, country, source, n, phrase: F.struct(F.lit(pos).alias("pos"), role.alias("code_1"), F.coalesce(country, F.lit("")).alias("country"), F.lit(source).alias("source"), n.alias("office_num"), phrase.alias("query"))
    given = lambda pos, item, country, source: F.when(item["code_1"].isNotNull(), code(pos, item["code_1"], country, source, item["n"], item["phrase"]))
    now = first(F.filter("current", lambda o: o["code_1"].isNotNull()))
    governed = F.exists("offices", lambda o: F.coalesce(o["code_1"] == "GOV", F.lit(False)))
    former = F.when((F.size("current") == 0) & governed, code(0, F.lit("ELI"), former_country, OFFICE, F.lit(0), F.lit("")))
    described, titled, typed = first(of(SHORT_DESCRIPTION)), first(of(BOX_TITLE)), first(of(BOX_TYPE))
    codes = F.array_compact(F.array(F.coalesce(given(0, now, now["country"], OFFICE), former), given(1, described, described["country"], SHORT_DESCRIPTION), given(2, titled, F.col("primary"), BOX_TITLE), given(3, typed, F.col("primary"), BOX_TYPE)))
    known_offices = countries(F.filter("offices", lambda o: o["term_start"].isNotNull()))
    voices = lambda cs: F.concat(F.filter(F.transform(cs, lambda c: c["country"]), lambda x: x != ""), "spoken", known_offices, countries(of(CATEGORY)))
    rows = rows.withColumn("codes", codes).withColumn("votes", voices(F.col("codes")))
    counted = F.transform(F.array_distinct("votes"), lambda v, i: F.struct(F.size(F.filter("votes", lambda x: x == v)).alias("n"), (-i).alias("early"), v.alias("country")))
    rows = rows.withColumns({"top": F.coalesce(F.array_max(counted)["country"], F.lit("")), "different": F.size(F.array_distinct("votes"))})
    filled = F.transform("codes", lambda c: c.withField("country", F.when((F.col("different") == 1) | (c["country"] == ""), F.col("top")).otherwise(c["country"])))
    bare = F.when(F.col("different") > 0, F.array(code(0, F.lit(""), F.col("top"), "Wiki", F.lit(0), F.lit("")))).otherwise(F.filter("codes", lambda _: F.lit(False)))
    return rows.select("title", "date", F.explode(F.when(F.size("codes") > 0, filled).otherwise(bare)).alias("c")).select("title", "date", "c.*")


def code_events(stories: DataFrame, answers: DataFrame, places: DataFrame, dims: Dimensions, articles: DataFrame | None = None, folder: str | None = None) -> DataFrame:
    """Coded events: a row per story, type and mode with its actors' and recipients' codes, place and date.

    answers(event_id, response) are the extractor's texts, places(orig_id, geo_ents) the geoparser's entities with spans;
    both come from models outside and are inputs here. With a folder that all executors share, the lengthened stories, the
    parsed answers and the coded mentions are written there once, instead of being computed in each branch that uses them.
    """
    kept = _keeper(folder)
    lengthened = kept(events.lengthen_stories(stories))
    n = _tasks(lengthened, folder)
    texts = lengthened.select(F.col("id").alias("event_id"), "pub_date", "event_text")
    parsed = events.parse_answers(dealt(answers.select("event_id", "response"), n, "event_id"))
    long = kept(events.attribute_rows(parsed).join(shuffled(dealt(texts, n, "event_id")), "event_id"))
    people = long.where(F.col("attr_type").isin("ACTOR", "RECIP")).withColumn("date", F.col("pub_date")).drop("pub_date", "event_text")
    mentions = people.groupBy("text", "date").agg(F.count("*").alias("n"))
    coded = spread_join(people, kept(agent_to_code(people, dims, articles, folder)), ["text", "date"], F.col("event_id"), mentions, "left", n).select("event_id", "attr_type", "pos", "text", F.coalesce("country", F.lit("")).alias("country"), F.coalesce("code_1", F.lit("")).alias("code_1"), F.coalesce("wiki", F.lit("")).alias("wiki"))
    named = events.country_names(coded, dims.countries)
    row = F.struct("pos", "text", "country", "code_1", "wiki", "country_name")
    of = lambda t, name: F.array_sort(F.collect_list(F.when(F.col("attr_type") == t, row))).alias(name)
    grouped = dealt(named, n, "event_id").groupBy("event_id").agg(of("ACTOR", "actors"), of("RECIP", "recipients"))
    first = lambda t: F.min(F.when(F.col("attr_type") == t, F.struct("pos", "text"))).getField("text").alias(t)
    said = dealt(long.where(F.col("attr_type").isin("LOC", "DATE")).select("event_id", "attr_type", "pos", "text"), n, "event_id").groupBy("event_id").agg(first("LOC"), first("DATE"))
    base = lengthened.select(F.col("id").alias("event_id"), "orig_id", "event_type", "event_mode", "pub_date", "event_text")
    placed = dealt(base, n, "orig_id").join(shuffled(dealt(places.select("orig_id", "geo_ents"), n, "orig_id")), "orig_id", "left")
    whole = dealt(placed, n, "event_id").join(shuffled(said), "event_id", "left").join(shuffled(grouped), "event_id", "left")
    at = F.instr(F.col("event_text"), F.col("LOC")) - 1
    loc = F.when(F.col("LOC").isNotNull(), F.struct(F.col("LOC").alias("text"), at.alias("start_char"), (at + F.length("LOC")).alias("end_char")))
    located = events.with_location(whole.withColumn("loc", loc))
    dated = resolve_dates(located, "DATE", "pub_date")
    return dated.select("event_id", "orig_id", "event_type", "event_mode", "actors", "recipients", F.col("reason").alias("place_reason"), "geo", "date_resolved", "date_raw")
