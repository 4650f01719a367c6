"""Actors to codes: country patterns, agent patterns, article codes, and the choice among codes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.dates import in_force
from eventloom.functions.phrases import chosen_phrase, compiled
from eventloom.functions.text import clean_query, fold_accents, folded, title_case, unmarked
from eventloom.operators import vector_index
from eventloom.operators.spread import dealt

#: Fixed domain values: the priority of each role code.
ROLE_PRIORITIES = {
    "IGO": 200, "ISM": 195, "IMG": 192, "PRE": 190, "REB": 130,
    "SPY": 110, "JUD": 105, "OPP": 102, "GOV": 100, "LEG": 90,
    "MIL": 80, "COP": 75, "PRM": 72, "ELI": 70, "PTY": 65,
    "BUS": 60, "UAF": 50, "CRM": 48, "LAB": 47, "MED": 45,
    "NGO": 43, "SOC": 42, "EDU": 41, "JRN": 40, "ENV": 39,
    "HRI": 38, "UNK": 37, "REF": 35, "AGR": 30, "RAD": 20,
    "CVL": 10, "JEW": 5, "MUS": 5, "BUD": 5, "CHR": 5,
    "HIN": 5, "REL": 1, "": 0, "JNK": 51, "NON": 60,
}
#: Fixed domain values: role codes that stand for a country of their own.
COUNTRY_ROLES = ["IGO", "MNC", "NGO", "ISM", "EUR", "UNO"]

#: Fixed domain values: why a code was chosen.
ONLY_CODE = "only one code"
SETTLEMENT = "It's a city/settlement, so no code1 applies"
ONLY_INFOBOX = "Only one entry in the info box"
FIRST_INFOBOX = "Picking highest priority Wiki info box title"
ONLY_ROLE_WIKI = "only one unique code1, returning wiki code"
ONLY_ROLE_CONFIDENT = "only one unique code1: returning highest conf"
SHORT_DESCRIPTION = "Picking Wiki short description"
ONLY_LOOKUP = "Using pre-wiki lookup"
EQUAL_LOOKUPS = "All pre-wiki lookups are the same"
PRIORITY_WIKI = "Ranked by code1 priority, returning wiki code"
PRIORITY_FIRST = "Ranked by code1 priority, returning first"


def role_priority(code: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in ROLE_PRIORITIES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code), F.lit(0))


def country_patterns(countries: DataFrame, categories: bool = False) -> DataFrame:
    """(ordinal, pattern, code, name): regular expressions for the nationalities and the name of each country.

    countries has ordinal, name, code and nationality (comma-parted). A nationality must end a word that goes on in no
    small letter; a name may stand inside a word. For categories each pattern follows "of " or "in ".
    """
    nationality = F.filter(F.transform(F.split("nationality", ","), lambda x: F.trim(x)), lambda x: x != "")
    ending = "" if categories else "(?=[^a-z]|$)"
    patterns = F.concat(F.transform(nationality, lambda x: F.concat(fold_accents(x), F.lit(ending))), F.array(fold_accents(F.col("name"))))
    one = countries.select("ordinal", "code", "name", F.posexplode(patterns).alias("k", "pattern"))
    if not categories:
        return one.select(F.struct(F.lit(0).alias("prefix"), "ordinal", "k").alias("ordinal"), "pattern", "code", "name")
    prefixes = F.array(F.struct(F.lit(0).alias("prefix"), F.lit("of ").alias("text")), F.struct(F.lit(1).alias("prefix"), F.lit("in ").alias("text")))
    two = one.select("*", F.explode(prefixes).alias("p"))
    return two.select(F.struct("p.prefix", "ordinal", "k").alias("ordinal"), F.concat("p.text", "pattern").alias("pattern"), "code", "name")


def find_country(texts: DataFrame, patterns: list[tuple[str, str]], method: str = "longest") -> DataFrame:
    """texts with country and rest: which of the patterns' (regular expression, value) pairs the text holds.

    All occurrences of a pattern are taken out to give the rest. longest chooses the pattern that leaves the shortest
    rest, first the one that stands earliest; of equal ones the one listed first. Without any, country is null and rest
    the text in ASCII letters (fold_accents); a null text has neither. The pattern list is a dimension of some hundreds
    or thousands of rows that goes with the tasks; each worker makes one automaton of it (functions.phrases), which reads
    a text once, however many patterns there are. Texts aren't shuffled.
    """
    if method not in ("longest", "first"):
        raise ValueError(f"method must be longest or first, not {method}")
    listed = tuple(map(tuple, patterns))

    @F.arrow_udf("struct<country: string, rest: string>")
    def scan(text: pa.Array) -> pa.Array:
        different, phrases = text.dictionary_encode(), compiled(listed)  # each different text of a batch is read once
        found = [chosen_phrase(folded(t), phrases, method) for t in different.dictionary.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], ["country", "rest"]).take(different.indices)

    return texts.withColumn("_best", scan(unmarked(F.col("text")))).withColumns({"country": F.col("_best.country"), "rest": F.col("_best.rest")}).drop("_best")


def parse_agents(lines: DataFrame) -> DataFrame:
    """(line, pattern, code_1, code_2) of agent dictionary lines(line, value).

    A line is a pattern and a code in brackets. Notes in braces, comments and macro definitions are left out; underscores
    are spaces. !minist! stands for four words in title case, !person! for five.
    """
    text = F.trim(F.regexp_replace(F.regexp_replace("value", r"\{.+?\}", ""), r"(?<=.)#.+", ""))
    kept = lines.where("value <> '' and not startswith(value, '#') and not startswith(value, '!')").withColumn("_text", text)
    code = F.trim(F.regexp_replace(F.regexp_extract("_text", r"(\[.+?\])", 1), r"[\[\]~]", ""))
    pattern = F.trim(F.lower(F.replace(F.regexp_replace("_text", r"\[.+?\]", ""), F.lit("_"), F.lit(" "))))
    coded = kept.where(F.col("_text").rlike(r"\[.+?\]")).select("line", pattern.alias("pattern"), F.substring(code, 1, 3).alias("code_1"), F.substr(code, F.lit(4)).alias("code_2"))
    words = lambda macro, values: F.array(*[F.replace("pattern", F.lit(macro), F.lit(v)) for v in values])
    minister = F.transform(words("!minist!", ["Minister", "Ministers", "Ministry", "Ministries"]), title_case)
    person = words("!person!", ["person", "man", "woman", "men", "women"])
    variants = F.when(F.contains("pattern", F.lit("!minist!")), minister).when(F.contains("pattern", F.lit("!person!")), person).otherwise(F.array("pattern"))
    return coded.select("line", F.explode(variants).alias("pattern"), "code_1", "code_2")


#: A dictionary of up to so many agent patterns goes with the tasks; a larger one gets an index. Queries that are compared at once.
AGENTS_A_PASS, QUERIES_AT_ONCE = 20_000, 256


def best_agent(queries: DataFrame, agents: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(query_id, pattern_id, conf) of queries(query_id, embedding): the agent pattern of the highest cosine, if it reaches the threshold.

    Agents are counted first. Up to AGENTS_A_PASS of them are one matrix, with which Arrow batches of queries are
    multiplied where they are. More are put in a vector index, and queries visit the cells that can hold a vector within
    the threshold (vector_index.within), to the same result. Of equal cosines the least pattern_id counts; a zero or null
    vector matches nothing.
    """
    rows = agents.select(F.col("pattern_id").cast("long").alias("pattern_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("embedding is not null")
    wanted = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("embedding is not null")
    n = rows.count()
    if n > AGENTS_A_PASS:
        found = vector_index.within(wanted, vector_index.build_index(rows.withColumnRenamed("pattern_id", "id")), threshold)
        return found.select("query_id", F.col("id").alias("pattern_id"), F.col("similarity").alias("conf"))
    if n == 0:
        return wanted.select("query_id", F.lit(None).cast("long").alias("pattern_id"), F.lit(None).cast("double").alias("conf")).where("false")
    known = rows.orderBy("pattern_id").toPandas()
    best = wanted.mapInArrow(_nearest(known["pattern_id"].to_numpy(), np.stack(known["embedding"].to_list())), "query_id long, pattern_id long, conf double")
    return best.where(F.col("conf") >= threshold)


def _nearest(ids: np.ndarray, vectors: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A kernel that gives each query of a batch the vector of the highest cosine, the first of equal ones."""

    def unit(rows: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore", divide="ignore"):
            return rows / np.linalg.norm(rows, axis=1, keepdims=True)

    known = np.nan_to_num(unit(vectors), nan=0.0)
    zero = ~known.any(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES_AT_ONCE):
                part = batch.slice(at, QUERIES_AT_ONCE)
                asked = unit(np.array(part.column(1).to_pylist(), np.float64))
                score = asked @ known.T
                score[:, zero] = -np.inf
                # equal cosines can differ in the last bits of a product: those within them count as equal
                best = (score >= score.max(axis=1, keepdims=True) - 1e-12).argmax(axis=1)
                conf = score[np.arange(len(best)), best]
                good = np.isfinite(conf)
                yield pa.record_batch([part.column(0).filter(pa.array(good)), pa.array(ids[best[good]]), pa.array(conf[good])], ["query_id", "pattern_id", "conf"])

    return run


def accept_directly(conf: Column, has_entities: Column, text: Column) -> Column:
    """Whether a direct agent match is good enough to skip the lookup."""
    return F.coalesce(((conf > 0.6) & ~has_entities) | ((conf > 0.9) & (F.lower(text) == text)) | (conf > 0.95), F.lit(False))


def parse_offices(infobox: Column) -> Column:
    """Offices of an infobox: array of (office, office_num, term_start, term_end), one for each key that names an office.

    A key's first run of digits is its number, by which office, term_start and term_end (or without underscore) are
    looked up; an office without a title of that number is left out. The keys are taken in order.
    """
    get = lambda *names: F.coalesce(*[F.try_element_at(infobox, n) for n in names])

    def office(key: Column) -> Column:
        num = F.regexp_extract(key, r"(\d+)", 1)
        date = lambda side: F.try_to_date(get(F.concat(F.lit(f"term_{side}"), num), F.concat(F.lit(f"term{side}"), num)), "yyyy-MM-dd")
        return F.struct(get(F.concat(F.lit("office"), num)).alias("office"), num.alias("office_num"), date("start").alias("term_start"), date("end").alias("term_end"))

    keys = F.filter(F.array_sort(F.map_keys(infobox)), lambda k: F.contains(k, F.lit("office")))
    return F.filter(F.transform(keys, office), lambda o: o["office"].isNotNull())


def active_offices(offices: Column, when: Column) -> Column:
    return F.filter(offices, lambda o: in_force(o["term_start"], o["term_end"], when))


def former_official(offices: Column, past_codes: Column, office_countries: Column, known_countries: Column, when: Column) -> Column:
    """struct(code_1, country) of someone whose offices are all over and who held one with the code GOV; else null.

    The country is that of the offices if they name one only and no other is known first, else the first known one.
    """
    over = (F.size(offices) > 0) & (F.size(active_offices(offices, when)) == 0) & F.array_contains(past_codes, "GOV")
    distinct = F.array_distinct(F.array_compact(office_countries))
    first = F.coalesce(F.get(known_countries, F.lit(0)), F.lit(""))
    only = F.get(distinct, F.lit(0))
    country = F.when((F.size(distinct) == 1) & ((first == "") | (first == only)), only).otherwise(first)
    return F.when(F.coalesce(over, F.lit(False)), F.struct(F.lit("ELI").alias("code_1"), country.alias("country")))


def majority(rows: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """(keys, value, n): the most frequent non-empty value for each key; of equal ones the one seen first.

    Two aggregations, both combined before they shuffle; no window over a key's rows.
    """
    counts = rows.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(position).alias("seen"))
    best = counts.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("seen")).alias("early"), value)).alias("best"))
    return best.select(*keys, F.col(f"best.{value}").alias(value), F.col("best.n").alias("n"))


def article_codes(codes: DataFrame, countries: DataFrame) -> DataFrame:
    """An article's codes with countries filled in; an article with countries but without codes gets one empty code.

    codes(article, pos, code_1, country, source), countries(article, pos, country): those of the codes come first. With
    one country in all, every code has it; else codes without one take the majority's.
    """
    everything = codes.select("article", F.col("pos").alias("pos"), "country").unionByName(countries.select("article", (F.col("pos") + 1_000_000).alias("pos"), "country"))
    top = majority(everything, ["article"], "country", "pos").select("article", F.col("country").alias("top"))
    unique = everything.where("country <> ''").groupBy("article").agg(F.count_distinct("country").alias("different"))
    known = top.join(unique, "article")
    filled = codes.join(known, "article", "left")
    country = F.when(F.col("different") == 1, F.col("top")).otherwise(F.when(F.coalesce("country", F.lit("")) == "", F.col("top")).otherwise(F.col("country")))
    named = filled.select("article", "pos", "code_1", country.alias("country"), "source")
    bare = known.join(codes.select("article").distinct(), "article", "left_anti")
    return named.unionByName(bare.select("article", F.lit(0).cast(codes.schema["pos"].dataType).alias("pos"), F.lit("").alias("code_1"), F.col("top").alias("country"), F.lit("Wiki").alias("source")))


def pick_best_code(codes: DataFrame, known: DataFrame, n: int | None = None) -> DataFrame:
    """(actor, code_1, code_2, country, source, wiki, best_reason): one code for each actor.

    codes(actor, pos, code_1, code_2, country, source, query, conf, office_num, wiki) are the candidates in order;
    known(actor, country) has the country that is known beforehand. Each rule of precedence ranks the candidates it
    accepts; an actor's code is the candidate of the first rule that accepts one: settlement, infobox office by number,
    one role only (from an article, else by confidence), short description, lookup before the article, role priority
    (from an article first). An actor with a country but no candidate gets that alone. Countries: unanimous, else known,
    else by majority. One aggregation by actor; a candidate list is short. With n, actors are dealt to so many tasks.
    """
    codes, known = dealt(codes, n, "actor"), dealt(known, n, "actor")
    row = F.struct("pos", "code_1", "code_2", "country", "source", "query", "conf", "office_num", "wiki")
    grouped = codes.groupBy("actor").agg(F.array_sort(F.collect_list(row)).alias("all"), F.max(F.when(F.col("wiki") != "", F.struct((-F.col("pos")).alias("p"), "wiki"))).alias("w"))
    actors = known.select("actor", F.col("country").alias("known")).join(grouped, "actor", "full_outer")
    vote = lambda country, pos: F.struct(country.alias("country"), pos.cast("long").alias("pos"))
    given = F.coalesce(F.transform("all", lambda c: vote(c["country"], c["pos"])), F.expr("cast(array() as array<struct<country:string,pos:bigint>>)"))
    actors = actors.withColumn("votes", F.filter(F.concat(given, F.array(vote(F.col("known"), F.lit(1 << 30)))), lambda v: F.coalesce(v["country"], F.lit("")) != ""))
    of = lambda country: F.filter("votes", lambda v: v["country"] == country)
    counted = F.transform(F.array_distinct(F.transform("votes", lambda v: v["country"])), lambda x: F.struct(F.size(of(x)).alias("n"), (-F.array_min(F.transform(of(x), lambda v: v["pos"]))).alias("early"), x.alias("country")))
    actors = actors.withColumn("counted", counted).withColumns({"top": F.array_max("counted")["country"], "different": F.size("counted")})
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    rows = F.col("all")
    roles = F.array_distinct(F.filter(F.transform(rows, lambda c: c["code_1"]), filled))
    coded = F.filter(rows, lambda c: filled(c["code_1"]))
    wiki_coded = F.filter(coded, lambda c: filled(c["wiki"]))
    by = lambda items, key: F.get(F.array_sort(F.transform(items, lambda c: F.struct(key(c).alias("key"), c["pos"].alias("pos"), c.alias("c")))), F.lit(0))["c"]
    infobox = F.filter(rows, lambda c: c["source"] == "Infobox")
    described = F.filter(rows, lambda c: c["source"] == "Wiki short description")
    boxed = F.get(F.filter(rows, lambda c: c["source"].isin("Infobox Type", "Infobox Title")), F.lit(0))
    before = F.filter(rows, lambda c: (c["source"] == "BERT matching on non-entity text") & filled(c["country"]) & filled(c["code_1"]))
    agree = (F.size(before) > 0) & (F.size(F.array_distinct(F.transform(before, lambda c: F.struct(c["country"], c["code_1"])))) == 1)
    priority = lambda c: F.struct(-role_priority(c["code_1"]), (~filled(c["wiki"])).cast("int"))
    ranked = by(rows, priority)
    rules: list[tuple[Column, Column, str]] = [
        (F.size(rows) == 1, F.get(rows, F.lit(0)), ONLY_CODE),
        (boxed["query"] == "settlement", boxed, SETTLEMENT),
        (F.size(infobox) == 1, F.get(infobox, F.lit(0)), ONLY_INFOBOX),
        (F.size(infobox) > 1, by(infobox, lambda c: F.coalesce(c["office_num"], F.lit(0))), FIRST_INFOBOX),
        ((F.size(roles) == 1) & (F.size(wiki_coded) > 0), F.get(wiki_coded, F.lit(0)), ONLY_ROLE_WIKI),
        (F.size(roles) == 1, by(coded, lambda c: -F.coalesce(c["conf"], F.lit(0.0))), ONLY_ROLE_CONFIDENT),
        (F.size(described) > 0, F.get(described, F.lit(0)), SHORT_DESCRIPTION),
        (F.size(before) == 1, F.get(before, F.lit(0)), ONLY_LOOKUP),
        (agree, F.get(before, F.lit(0)), EQUAL_LOOKUPS),
        ((F.size(rows) > 1) & filled(ranked["wiki"]), ranked, PRIORITY_WIKI),
        (F.size(rows) > 1, ranked, PRIORITY_FIRST),
    ]
    choice = reduce(lambda c, r: c.when(r[0], F.struct(r[1].alias("c"), F.lit(r[2]).alias("reason"))), rules[1:], F.when(rules[0][0], F.struct(rules[0][1].alias("c"), F.lit(rules[0][2]).alias("reason"))))
    chosen = actors.withColumn("pick", choice)
    reason, own = F.col("pick.reason"), F.col("pick.c.country")
    best_country = F.when(F.col("different") == 1, F.col("top")).otherwise(F.coalesce(F.when(filled(F.col("known")), F.col("known")), F.col("top"), F.lit("")))
    keeps_own = reason.isin(ONLY_CODE, SETTLEMENT)
    intergovernmental = reason.isin(ONLY_INFOBOX, FIRST_INFOBOX, SHORT_DESCRIPTION) & (F.col("pick.c.code_1") == "IGO")
    country = (
        F.when(F.col("pick").isNull(), F.col("known"))
        .when(keeps_own, F.when(filled(own), own).when(reason == ONLY_CODE, F.coalesce("known", F.lit(""))).otherwise(best_country))
        .when(intergovernmental, F.lit("IGO"))
        .otherwise(best_country)
    )
    found = chosen.where(F.col("pick").isNotNull() | filled(F.col("known")))
    return found.select(
        "actor",
        F.when(reason == SETTLEMENT, "").otherwise(F.coalesce("pick.c.code_1", F.lit(""))).alias("code_1"),
        F.coalesce("pick.c.code_2", F.lit("")).alias("code_2"),
        country.alias("country"),
        F.coalesce("pick.c.source", F.lit("country only")).alias("source"),
        F.coalesce(F.when(filled(F.col("pick.c.wiki")), F.col("pick.c.wiki")), "w.wiki", F.lit("")).alias("wiki"),
        F.coalesce(reason, F.lit("")).alias("best_reason"),
    )


def clean_best(codes: DataFrame) -> DataFrame:
    """codes with code_1 and country normalised: no country for junk, roles that are countries, composite codes split."""
    junk = F.col("code_1").isin("JNK", "NON")
    special = F.col("code_1").isin(*COUNTRY_ROLES)
    country = F.coalesce(F.when(special, F.col("code_1")).when(junk, "").otherwise(F.col("country")), F.lit(""))
    composite = F.length(country) == 6
    code = F.when(composite, F.substring(country, 4, 3)).when(special, "").otherwise(F.col("code_1"))
    return codes.withColumns({"code_1": code, "country": F.when(composite, F.substring(country, 1, 3)).otherwise(country)})


def strip_entities(tokens: Column) -> Column:
    """The text of the tokens (text, ws, ent_type) that belong to no entity and aren't function words."""
    kept = F.filter(tokens, lambda t: (t["ent_type"] == "") & ~t["text"].isin("a", "and", "the", "'s", "'", "s"))
    return F.trim(F.array_join(F.transform(kept, lambda t: F.concat(t["text"], t["ws"])), ""))


def noun_phrases(chunks: Column) -> Column:
    """Noun chunks (arrays of tokens) whose last token belongs to no entity, without function words and numbers, in lower case."""
    plain = F.filter(chunks, lambda c: F.element_at(c, -1)["ent_type"] == "")
    words = lambda c: F.filter(c, lambda t: ~t["text"].isin("a", "and", "the") & ~t["ent_type"].isin("CARDINAL", "DATE", "ORDINAL"))
    return F.filter(F.transform(plain, lambda c: F.lower(F.trim(F.array_join(F.transform(words(c), lambda t: F.concat(t["text"], t["ws"])), "")))), lambda x: x != "")


def acronyms(entities: Column) -> Column:
    """map of initials to entity text: entities (text, label, words) of several capitalised words; later ones replace earlier."""
    seeds = F.array(F.struct(F.lit("U.N.").alias("key"), F.lit("United Nations").alias("value")), F.struct(F.lit("UN").alias("key"), F.lit("United Nations").alias("value")))
    numeric = ["CARDINAL", "DATE", "MONEY", "ORDINAL", "PERCENT", "QUANTITY", "TIME"]
    words = lambda e: F.filter(e["words"], lambda w: ~w["pos"].isin("DET", "ADP"))
    good = F.filter(entities, lambda e: (F.size(e["words"]) > 1) & (F.upper(e["text"]) != e["text"]) & ~e["label"].isin(*numeric) & F.forall(words(e), lambda w: w["text"].rlike(r"^\p{Lu}")))
    entries = F.concat(seeds, F.transform(good, lambda e: F.struct(F.array_join(F.transform(words(e), lambda w: F.substring(w["text"], 1, 1)), "").alias("key"), e["text"].alias("value"))))
    last = F.aggregate(entries, F.expr("cast(map() as map<string,string>)"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))))
    return last


def expand_query(query: Column, entities: Column, initials: Column) -> Column:
    """The first entity text that holds the query, if longer, else the query; then, up to twice, what its initials stand for."""
    first = F.get(F.filter(entities, lambda e: F.contains(e, query)), F.lit(0))
    wide = F.when(F.length(first) > F.length(query), first).otherwise(query)
    once = F.coalesce(F.try_element_at(initials, wide), wide)
    return F.coalesce(F.try_element_at(initials, once), once)


def cleaned_mentions(mentions: DataFrame) -> DataFrame:
    """mentions with query, the cleaned text."""
    return mentions.withColumn("query", clean_query(F.col("text")))


def resolve_once(mentions: DataFrame, keys: list[str], resolve) -> DataFrame:  # noqa: ANN001
    """mentions with what resolve adds, computed once for each different key: distinct, resolve, join back."""
    return mentions.join(resolve(mentions.select(*keys).distinct()), keys, "left")


def spread_codes(codes: DataFrame) -> DataFrame:
    """(actor, all_code1s, all_code2s, countries): the different codes and countries of each actor, sorted; IGO isn't listed as a role."""
    kept = lambda c: F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c))))
    first = F.array_sort(F.collect_set(F.when(~F.col("code_1").isin("", "IGO"), F.col("code_1"))))
    return codes.groupBy("actor").agg(first.alias("all_code1s"), kept("code_2").alias("all_code2s"), kept("country").alias("countries"))


def rank_first(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order, which must be total."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
