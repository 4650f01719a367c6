"""Sources and sinks: rows written in each format and read back, and the whole chain on stories made of the tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.plans.coding import Dimensions, article_roles, code_events
from eventloom.plans.registry import query, scratch, table
from eventloom.sources import readers, sinks
from eventloom.streaming.stories import event_stream, story_stream


def _stories(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """A story for each order, with more columns of it."""
    none = F.lit(None).cast("string")
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"), none.alias("date"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("pub_date"), F.concat(F.lit("Ringish police met the anvil men in place"), key).alias("event_text"), none.alias("headline"), none.alias("publisher"), key.alias("story_id"), F.lit("1").alias("version"),
        F.array(F.col("o_orderstatus")).alias("event_type"), F.array(F.concat(F.col("o_orderstatus"), F.lit("-x"))).alias("event_mode"), F.array().cast("array<string>").alias("contexts"),
        *more,
    )


@query("select o_orderkey::varchar as id, strftime(o_orderdate, '%Y-%m-%d') as pub_date from orders")
def s1_k1_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    sinks.write_events(_stories(spark, sf_dir), path)
    return readers.read_stories(spark, path).select("id", "pub_date")


@query("select count(*) as stories, 0::bigint as first, count(*) - 1 as last, 10::bigint as limited from orders")
def s2_story_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    sinks.write_events(_stories(spark, sf_dir), path)
    whole = readers.read_stories(spark, path, -1).agg(F.count("*").alias("stories"), F.min("doc_position").alias("first"), F.max("doc_position").alias("last"))
    return whole.join(readers.read_stories(spark, path, 10).agg(F.count("*").alias("limited")))


@query("select n_nationkey::varchar as code, n_name as name from nation union all select '', '' union all select 'IGO', 'Intergovernmental Organization'")
def s4_country_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    rows = table(spark, sf_dir, "nation").select(F.lit("x").alias("CCA2"), F.col("n_name").alias("Name"), F.col("n_nationkey").cast("string").alias("CCA3"), F.lower("n_name").alias("Nationality"))
    sinks.write_scores(rows, path)
    return readers.country_lookup(readers.read_countries(spark, path))


@query("select n_name as event, 'about, ' || n_name as event_def, null::varchar as extraction_notes from nation")
def s6_codebook_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    sinks.write_scores(table(spark, sf_dir, "nation").select(F.col("n_name").alias("event"), F.concat(F.lit("about, "), "n_name").alias("event_def"), F.lit("m").alias("mode")), path)
    return readers.read_codebook(spark, path).select("event", "event_def", "extraction_notes")


@query("select page_id::varchar as title, url as text from pages where page_id % 3 > 0 union all select page_id::varchar, '' from pages where page_id % 3 = 0")
def s8_xml_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    pages = table(spark, sf_dir, "pages")
    body = F.when(F.col("page_id") % 3 > 0, F.col("url"))
    xml = pages.select(F.col("page_id").cast("string").alias("title"), F.struct(F.struct(body.alias("_VALUE"), F.length("url").alias("_bytes")).alias("text")).alias("revision"))
    xml.write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").option("compression", "bzip2").save(path)
    return readers.read_dump(spark, path)


@query("select p_brand as target, list_sort(list_distinct(list(p_name || ';'))) as redirects from part group by p_brand")
def k4_redirect_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    sinks.write_redirects(table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("target")).agg(F.array_sort(F.collect_set(F.concat("p_name", F.lit(";")))).alias("redirects")), f"{path}/redirects3")
    sinks.write_redirects(spark.createDataFrame([], "target string, redirects array<string>"), f"{path}/redirects2")
    return spark.read.parquet(readers.latest_version(spark, path, "redirects"))


@query("select o_orderstatus as kind, o_orderkey as a from orders")
def k6_pair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    sinks.write_pairs(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("kind"), F.col("o_orderkey").alias("a")), path, by="kind")
    return spark.read.schema("a long, kind string").json(path).select("kind", "a")


@query("select 'query: ' || p_partkey || ' | expected: ' || p_brand || ' | found: ' || case when p_partkey % 3 = 0 then '-' else p_type end as value from part where p_partkey % 2 = 0")
def k8_miss_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    found = F.when(F.col("p_partkey") % 2 == 1, F.col("p_brand")).when(F.col("p_partkey") % 3 > 0, F.col("p_type"))
    sinks.write_misses(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("query"), F.col("p_brand").alias("expected"), found.alias("found")), path)
    return spark.read.text(path)


@query("select n_nationkey, n_name from nation")
def k2_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(sinks.snapshot(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), scratch(spark), "geolocation", datetime(2020, 1, 2, 3)))


@query("select c_custkey, c_nationkey from customer where c_custkey % 50 <= 25 and (c_custkey % 4 = 0 or c_custkey % 50 + 10 >= 25)")
def s0_codes_valid_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (F.col("c_custkey") % 50).cast("int")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", start.alias("valid_from"), F.when(F.col("c_custkey") % 4 > 0, start + 10).alias("valid_until"))
    return readers.codes_valid_in(rows, F.lit(25)).select("c_custkey", "c_nationkey")


@query("select o_orderkey || '_' || o_orderstatus || '_x' as id, o_orderstatus as event_type, 'x' as event_mode from orders")
def st1_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every story arrives twice; the stream drops the copies within the watermark and lengthens the rest."""
    source, out, state = (f"{scratch(spark)}/{k}" for k in ("in", "out", "state"))
    stories = _stories(spark, sf_dir)
    sinks.write_events(stories.unionByName(stories), source)
    events = event_stream(story_stream(spark, source), "4000 days")
    events.select("id", "event_type", "event_mode").writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


@query("""
select o_orderkey || '_' || o_orderstatus || '_x' as event_id, o_orderstatus as event_type, case o_custkey % 4 when 2 then 'ANV' else 'RNG' end as actor_country, case o_custkey % 4 when 0 then 'COP' when 1 then 'ELI' when 2 then 'CVL' else 'COP' end as actor_role,
 case when o_custkey % 4 < 3 then 'Lord' || o_custkey else '' end as actor_wiki, 'ANV' as recipient_country, 'CVL' as recipient_role, 'A place overlaps' as place_reason, o_orderkey % 9 as place, strftime(o_orderdate::date - 1, '%Y-%m-%d') as date_resolved from orders""")
def e1_code_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain from stories to coded events: a story for each order, its actor the order's customer.

    One customer in four is named by a role alone; the others are articles, whose office is in force, or over, or who have
    only a short description.
    """
    stories = _stories(spark, sf_dir, "o_custkey")
    event_id = F.concat_ws("_", "id", F.col("event_type")[0], F.lit("x"))
    place, key = F.concat(F.lit("place"), "id"), F.col("o_custkey")
    lord = F.concat(F.lit("Lord"), key.cast("string"))
    actor = F.when(key % 4 == 3, "the Ringish police").otherwise(lord)
    answer = F.format_string('[{"event_type": "x", "anchor_quote": "q", "actor": "%s", "recipient": ["anvil men"], "date": "yesterday", "location": "%s"}]', actor, place)
    answers = stories.select(event_id.alias("event_id"), answer.alias("response"))
    start = F.instr(F.col("event_text"), place) - 1
    entity = F.struct(start.alias("start_char"), (start + F.length(place)).alias("end_char"), F.lit(0.9).alias("score"), (F.col("id").cast("long") % 9).alias("geonameid"))
    places = stories.select(F.col("id").alias("orig_id"), F.array(entity).alias("geo_ents"))
    roles = spark.createDataFrame([("police", "COP", ""), ("minister", "GOV", ""), ("men", "CVL", "")], "pattern string, code_1 string, code_2 string")
    dims = Dimensions([("Ringish", "RNG"), ("anvil", "ANV")], spark.createDataFrame([("RNG", "Ring"), ("ANV", "Anvil")], "code string, name string"), roles)
    key = F.col("c_custkey")
    title = F.concat(F.lit("Lord"), key.cast("string"))
    office = lambda name, begin, end: F.map_from_entries(F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, v in (("office1", F.lit(name)), ("term_start1", F.lit(begin)), ("term_end1", F.lit(end).cast("string")))])))
    box = F.when(key % 4 == 0, office("Ringish police", "1990-01-01", None)).when(key % 4 == 1, office("Ringish minister", "1980-01-01", "1989-12-31")).otherwise(F.expr("cast(map() as map<string,string>)"))
    none = F.expr("cast(array() as array<string>)")
    intro = F.concat(title, F.lit(" holds land and has been known for it in many countries and for a long time."))
    articles = table(spark, sf_dir, "customer").where(key % 4 < 3).select(title.alias("title"), F.when(key % 4 == 2, "anvil men").alias("short_desc"), intro.alias("intro_para"), none.alias("redirects"), none.alias("alternative_names"), none.alias("affiliated_people"), F.lit("person").alias("box_type"), box.alias("infobox"), none.alias("categories"))
    coded = code_events(stories.drop("o_custkey"), answers, places, dims, articles, scratch(spark))
    first, recipient = F.get("actors", F.lit(0)), F.get("recipients", F.lit(0))
    return coded.select("event_id", "event_type", first["country"].alias("actor_country"), first["code_1"].alias("actor_role"), first["wiki"].alias("actor_wiki"), recipient["country"].alias("recipient_country"), recipient["code_1"].alias("recipient_role"), "place_reason", F.col("geo.geonameid").alias("place"), "date_resolved")


_EVIDENCE_SQL = """
with a as (select c_custkey as k, c_custkey % 11 as m, case when c_custkey % 2 = 0 then 'N' || (c_custkey % 25) end as fs, case when c_custkey % 3 = 0 then 'N' || ((c_custkey // 25) % 25) end as sd, case when c_custkey % 5 < 2 then 'N' || ((c_custkey + 7) % 25) end as bc,
  case when c_custkey % 11 < 5 then 'N' || ((c_custkey * 3) % 25) end as off, case when c_custkey % 6 < 3 then 'N' || ((c_custkey + 1) % 25) end as cat, case when c_custkey % 6 < 3 then 'N' || ((c_custkey + 2) % 25) end as cat2 from customer),
p as (select *, coalesce(fs, sd, bc) as prim from a),
codes as (select k, 0 as pos, case when m < 3 then 'GOV' else 'ELI' end as code_1, case when m < 3 or prim is null then off else prim end as country, 'Infobox' as source from p where m < 5
  union all select k, 1, 'COP', sd, 'Wiki short description' from p where sd is not null union all select k, 2, 'GOV', prim, 'Infobox Title' from p where k % 7 = 0 union all select k, 3, 'MIL', prim, 'Infobox Type' from p where k % 4 = 0),
votes as (select k, pos, country from codes union all select k, 10, fs from p union all select k, 11, sd from p union all select k, 12, bc from p union all select k, 20, off from p union all select k, 30, cat from p union all select k, 31, cat2 from p),
counts as (select k, country, count(*) as n, min(pos) as seen from votes where country is not null group by 1, 2), known as (select k, arg_max(country, (n, -seen)) as top, count(*) as different from counts group by k)
select 'Town ' || k as title, pos, code_1, coalesce(case when different = 1 or country is null then top else country end, '') as country, source from codes left join known using (k)
union all select 'Town ' || k, 0, '', top, 'Wiki' from known where k not in (select k from codes)"""


@query(_EVIDENCE_SQL)
def t20_article_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What articles say of codes and countries: one for each customer, each place of which speaks in some and is silent in others."""
    key = F.col("c_custkey")
    nation = lambda n: F.concat(F.lit("NATION_"), F.pmod(n, F.lit(25)).cast("string"))
    entry = lambda given, name, value: F.when(given, F.struct(F.lit(name).alias("key"), value.alias("value")))
    office = F.when(key % 11 < 5, F.concat(nation(key * 3), F.lit(" minister"))).otherwise("keeper")
    entries = [entry(key % 5 < 2, "country", nation(key + 7)), entry(key % 4 == 0, "type", F.lit("army")), entry(key % 11 < 6, "office1", office), entry(key % 11 < 6, "term_start1", F.lit("1980-01-01")), entry((key % 11).isin(3, 4), "term_end1", F.lit("1989-12-31"))]
    intro = F.concat(F.lit("A place (of NATION_9) known"), F.when(key % 2 == 0, F.concat(F.lit(" in "), nation(key), F.lit(" and from NATION_24"))).otherwise(""), F.lit(".\nIt lies in NATION_5."))
    categories = F.when(key % 6 < 3, F.array(F.concat(F.lit("People of "), nation(key + 1)), F.lit("1950 births, NATION_8"), F.concat(F.lit("Towns in "), nation(key + 2))))
    articles = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Town "), key.cast("string")).alias("title"), F.when(key % 3 == 0, F.concat(nation(F.floor(key / 25)), F.lit(" police"))).when(key % 3 == 1, "a painter").alias("short_desc"), intro.alias("intro_para"),
        F.when(key % 7 == 0, "minister").when(key % 7 == 1, "settlement").alias("box_type"), F.map_from_entries(F.array_compact(F.array(*entries))).alias("infobox"), categories.alias("categories"),
    )
    roles = spark.createDataFrame([("police", "COP", ""), ("minister", "GOV", ""), ("army", "MIL", "")], "pattern string, code_1 string, code_2 string")
    nations = [(r.n_name, f"N{r.n_nationkey}") for r in table(spark, sf_dir, "nation").orderBy(-F.length("n_name"), "n_nationkey").collect()]  # a dimension
    dims = Dimensions(nations, table(spark, sf_dir, "nation"), roles, [(f"{word} {name}", code) for word in ("of", "in") for name, code in nations])
    return article_roles(articles.select("title", F.lit("1995-01-01").alias("date")), articles, dims).select("title", "pos", "code_1", "country", "source")
