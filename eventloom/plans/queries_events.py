"""Stories, events, extractor answers, places and presentation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import actors, events
from eventloom.plans.registry import query, table

_STORIES_SQL = """(select o_orderkey::varchar as id, [o_orderstatus, 'O'] as types, [o_orderstatus || '-' || lower(o_orderpriority), 'O', 'X-none', 'F-' || o_orderpriority] as modes, o_orderpriority from orders)"""
_EVENTS_SQL = f"""(select id as orig_id, ty as event_type, mode as event_mode, id || '_' || ty || '_' || mode as id from (
 select id, ty, unnest(case when len(own) = 0 then [''] else list_transform(own, lambda x: case when strpos(x, '-') > 0 then substr(x, strpos(x, '-') + 1) else '' end) end) as mode
 from (select id, ty, list_filter(modes, lambda x: split_part(x, '-', 1) = ty) as own from (select id, unnest(types) as ty, modes from {_STORIES_SQL}))))"""


def _stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    modes = F.array(F.concat_ws("-", status, F.lower(priority)), F.lit("O"), F.lit("X-none"), F.concat(F.lit("F-"), priority))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.array(status, F.lit("O")).alias("event_type"), modes.alias("event_mode"))


@query(f"select id, orig_id, event_type, event_mode from {_EVENTS_SQL}")
def p1_story_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.lengthen_stories(_stories(spark, sf_dir)).select("id", "orig_id", "event_type", "event_mode")


@query(f"""
select orig_id, arg_max(event_mode, (p, event_mode)) as event_mode, max(p)::int as priority from (
 select orig_id, event_mode, case substr(event_mode, 1, 1) when '1' then 200 when '2' then 100 when '3' then 80 when '4' then 10 else 0 end as p from {_EVENTS_SQL}) group by orig_id""")
def w1_t23_top_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengthened = events.lengthen_stories(_stories(spark, sf_dir))
    code = F.element_at(F.create_map(*[F.lit(x) for pair in {"1": "IGO", "2": "GOV", "3": "MIL", "4": "CVL"}.items() for x in pair]), F.substring("event_mode", 1, 1))
    ranked = lengthened.withColumn("priority", actors.role_priority(F.coalesce(code, F.lit(""))))
    return actors.rank_first(ranked, ["orig_id"], F.desc("priority"), F.desc("event_mode")).select("orig_id", "event_mode", "priority")


@query("""
select p_brand, list_sort(list_distinct(list(w) filter (where n % 3 = 0))) as story_people, coalesce(list_sort(list_distinct(list(w) filter (where n % 3 = 1))), []) as story_organizations, coalesce(list_sort(list_distinct(list(w) filter (where n % 3 = 2))), []) as story_places
from (select p_brand, unnest(string_split(p_name, ' ')) as w, length(unnest(string_split(p_name, ' '))) as n from part) group by p_brand""")
def p2_entity_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "part").select("p_brand", F.explode(F.split("p_name", " ")).alias("text"))
    label = F.when(F.length("text") % 3 == 0, "PERSON").when(F.length("text") % 3 == 1, "ORG").otherwise("GPE")
    docs = words.groupBy(F.col("p_brand").alias("doc_position")).agg(F.collect_list(F.struct("text", label.alias("label"))).alias("ents"))
    return events.entity_sets(docs).withColumnRenamed("doc_position", "p_brand")


@query("select o_orderkey, c_name from orders join customer on o_custkey = c_custkey")
def j1_positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    stories = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("doc_position"))
    return events.attach_documents(stories, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_position"), "c_name")).select("o_orderkey", "c_name")


@query("select vec_id, list_transform(list_filter([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16], lambda i: abs(embedding[i]::double) * 5 > 0.6), lambda i: ['ACCUSE', 'AGREE', 'AID', 'ASSAULT', 'COERCE', 'CONCEDE', 'CONSULT', 'COOPERATE', 'MOBILIZE', 'PROTEST', 'REJECT', 'REQUEST', 'RETREAT', 'SANCTION', 'SUPPORT', 'THREATEN'][i]) as event_type from embeddings")
def f4_types_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    probabilities = F.transform(F.slice("embedding", 1, 16), lambda x: F.abs(x.cast("double")) * 5)
    return table(spark, sf_dir, "embeddings").select("vec_id", events.types_above(probabilities).alias("event_type"))


@query("""
select event_id, '### Document' || chr(10) || event_type || chr(10) || chr(10) || '### Event' || chr(10) || 'about ' || event_type || case when user_id % 2 = 0 then chr(10) || chr(10) || '### Specific Sub-Event' || chr(10) || props else '' end
 || case when user_id % 3 = 0 then chr(10) || chr(10) || '### Special Instructions' || chr(10) || 'mind ' || event_type else '' end || chr(10) || chr(10) || 'Answer with a JSON list.' as prompt from events""")
def p5_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id")
    prompt = events.build_prompt(kind, F.concat(F.lit("about "), kind), F.when(user % 2 == 0, F.col("props")), F.when(user % 3 == 0, F.concat(F.lit("mind "), kind)))
    return table(spark, sf_dir, "events").select("event_id", prompt.alias("prompt"))


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, kind, user = F.col("event_id") % 5, F.col("event_type"), F.col("user_id").cast("string")
    one = F.format_string('[{"event_type": "%s", "anchor_quote": "q", "actor": "u%s; v ", "recipient": ["a ", "b"], "date": "N/A", "location": "x"}]', kind, user)
    response = F.when(k == 0, F.concat(F.lit("<think>[hm]\n\n</think> "), one)).when(k == 1, one).when(k == 2, "[]").when(k == 3, "no JSON").otherwise(F.lit('[{"actor": '))
    return table(spark, sf_dir, "events").select("event_id", response.alias("response"))


@query("select event_id, (event_id % 5 >= 3) as failed, case when event_id % 5 < 2 then ['u' || user_id, 'v'] end as actor, case when event_id % 5 < 2 then ['a', 'b'] end as recipient from events")
def p4_p6_parse_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = events.parse_answers(_answers(spark, sf_dir))
    first = F.get("events", F.lit(0))
    return parsed.select("event_id", "failed", first["actor"].alias("actor"), first["recipient"].alias("recipient"))


@query("select count(*) filter (where event_id % 5 >= 3) as errors, count(*) as answers from events")
def a15_error_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.parse_answers(_answers(spark, sf_dir)).agg(F.count_if("failed").alias("errors"), F.count("*").alias("answers"))


@query("""
with e as (select event_id, user_id from events where event_id % 5 < 2)
select event_id, 'ACTOR' as attr_type, 0 as pos, 'u' || user_id as text from e union all select event_id, 'ACTOR', 1, 'v' from e
union all select event_id, 'RECIP', 0, 'a' from e union all select event_id, 'RECIP', 1, 'b' from e union all select event_id, 'LOC', 0, 'x' from e""")
def d1_attribute_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.attribute_rows(events.parse_answers(_answers(spark, sf_dir)))


@query("""
with book as (select row_number() over (order by s_suppkey) as n, n_regionkey, s_nationkey, s_name from supplier join nation on s_nationkey = n_nationkey),
t as (select n_regionkey, arg_min(s_name, n) as event_def from book group by 1), m as (select n_regionkey, s_nationkey, arg_min('m' || s_name, n) as mode_def from book group by 1, 2)
select c_custkey, event_def, mode_def from customer join nation on c_nationkey = n_nationkey left join t using (n_regionkey) left join m on m.n_regionkey = nation.n_regionkey and s_nationkey = n_nationkey""")
def j2_codebook_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    book = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    book = book.select(F.col("n_regionkey").alias("event"), F.col("s_nationkey").alias("mode"), F.col("s_name").alias("event_def"), F.concat(F.lit("m"), "s_name").alias("mode_def"), F.lit(None).cast("string").alias("extraction_notes"), F.col("s_suppkey").alias("ordinal"))
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_regionkey").alias("event_type"), F.col("n_nationkey").alias("event_mode"))
    return events.codebook_lookup(rows, book).select("c_custkey", "event_def", "mode_def")


@query("""
with e as (select o_orderkey, case when o_orderkey % 7 > 0 then o_orderkey % 60 end as s from orders),
x as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_linenumber * 10 as f, l_linenumber * 10 + l_quantity::int as t from lineitem),
o as (select o_orderkey, greatest(least(s + 12, t) - greatest(s, f), 0) / (greatest(12 + t - f - greatest(least(s + 12, t) - greatest(s, f), 0), 1))::double as iou, l_linenumber as n, l_partkey, l_suppkey, l_quantity, l_discount from e join x on o_orderkey = l_orderkey),
b as (select o_orderkey, max(iou) as iou, arg_max({'n': n, 'd': l_discount}, (iou, -n, -l_partkey, -l_suppkey, -l_quantity, -l_discount)) as p from o where iou is not null group by o_orderkey)
select e.o_orderkey as event_id, case when s is not null then round(iou, 9) end as overlap, case when s is null then 'No location attribute' when iou is null then 'No place was geolocated: entities are missing'
  when iou < 0.5 then 'The location doesn''t overlap enough with any place' when p.d * 10 > 0.3 then 'A place overlaps' else 'A place overlaps but its score is too low' end as reason,
 case when s is not null and iou >= 0.5 and p.d * 10 > 0.3 then p.n end as place from e left join b using (o_orderkey)""")
def t25_event_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    entity = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount")
    geo = F.transform(F.array_sort(F.collect_list(entity)), lambda x: F.struct(x["l_linenumber"].alias("n"), (x["l_linenumber"] * 10).alias("start_char"), (x["l_linenumber"] * 10 + x["l_quantity"].cast("int")).alias("end_char"), (x["l_discount"] * 10).alias("score")))
    places = lines.groupBy("l_orderkey").agg(geo.alias("geo_ents"))
    start = (F.col("o_orderkey") % 60).cast("int")
    loc = F.when(F.col("o_orderkey") % 7 > 0, F.struct(F.lit("t").alias("text"), start.alias("start_char"), (start + 12).alias("end_char")))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), loc.alias("loc")).join(places, F.col("event_id") == F.col("l_orderkey"), "left")
    return events.match_location(rows, min_score=0.3).select("event_id", F.round("overlap", 9).alias("overlap"), "reason", F.col("geo.n").alias("place"))


@query("""
select s_suppkey, 'p' || s_suppkey as resolved_placename, n_name as country_name from supplier left join (select * from nation where n_nationkey < 20) on s_nationkey = n_nationkey""")
def p8_name_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").where("n_nationkey < 20").agg(F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), "n_name"))).alias("names"))  # a dimension of one row per country
    ents = F.array(F.struct(F.concat(F.lit("p"), F.col("s_suppkey").cast("string")).alias("name"), F.col("s_nationkey").cast("string").alias("country_code3")))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", ents.alias("ents")).join(F.broadcast(names))
    return rows.select("s_suppkey", F.inline(events.name_places(F.col("ents"), F.col("names")))).select("s_suppkey", "resolved_placename", "country_name")


@query("""
select o_orderkey, case when o_orderstatus in ('P') then null else coalesce(n_name, '') end as country_name from orders join customer on o_custkey = c_custkey left join (select * from nation where n_nationkey < 20) on c_nationkey = n_nationkey""")
def p9_country_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "LOC").otherwise("ACTOR").alias("attr_type"), F.col("c_nationkey").alias("country"))
    dims = table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    return events.country_names(attributes, dims).select("o_orderkey", "country_name")


@query("""
with g as (select o_custkey, string_agg(o_orderkey::varchar, '; ' order by o_orderkey) as t, string_agg(o_orderstatus || ' ' || o_orderpriority, '; ' order by o_orderkey) as c, string_agg('w' || o_orderkey, '; ' order by o_orderkey) as w, max(case when o_orderstatus = 'P' then o_orderpriority end) as p from orders group by o_custkey)
select o_custkey as event_id, 'actor_texts' as attribute, t as value from g union all select o_custkey, 'actor_codes', c from g union all select o_custkey, 'actor_wikis', w from g union all select o_custkey, 'place', coalesce(p, '') from g""")
def k9_presentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    row = F.struct(key.alias("k"), key.cast("string").alias("text"), F.col("o_orderstatus").alias("country"), F.col("o_orderpriority").alias("code_1"), F.concat(F.lit("w"), key.cast("string")).alias("wiki"))
    grouped = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("event_id")).agg(F.array_sort(F.collect_list(row)).alias("actors"), F.max(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))).alias("place"))
    return events.present(grouped)
