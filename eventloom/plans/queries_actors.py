"""Country patterns, agent patterns, offices, majority votes and the choice among codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import actors, mentions, vector_index
from eventloom.plans.registry import query, scratch, table
from eventloom.sources.sinks import checkpointed

_PATTERNS = [("small ring(?=[^a-z]|$)", "RNG"), ("Ringish(?=[^a-z]|$)", "RNG"), ("Ring", "RNG"), ("widget(?=[^a-z]|$)", "WID"), ("Widgets(?=[^a-z]|$)", "WID"), ("Widget", "WID"), ("bolt(?=[^a-z]|$)", "BLT"), ("red bolt(?=[^a-z]|$)", "BLT"), ("Bolt", "BLT"), ("large bolt(?=[^a-z]|$)", "OBT"), ("Old Bolt", "OBT"), ("anvil(?=[^a-z]|$)", "ANV"), ("Anvil", "ANV")]


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations in the shape of the country list: their nationalities are the names of parts that are theirs."""
    nation, name = table(spark, sf_dir, "nation"), table(spark, sf_dir, "part").select("p_name").distinct()
    of = nation.join(name, F.pmod(F.length("p_name"), F.lit(5)) == F.col("n_nationkey") % 5)
    listed = of.groupBy("n_nationkey", "n_name").agg(F.array_join(F.array_sort(F.collect_set(F.concat("p_name", F.lit(" of "), "n_name"))), ", ").alias("nationality"))
    return listed.select(F.col("n_nationkey").alias("ordinal"), F.col("n_name").alias("name"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"), "nationality")


_NATION_PATTERNS_SQL = """
l as (select n_nationkey as ordinal, 'N' || n_nationkey as code, n_name, list_sort(list(distinct p_name || ' of ' || n_name)) as nats from nation join (select distinct p_name from part) on length(p_name) % 5 = n_nationkey % 5 group by n_nationkey, n_name),
pats as (select ordinal, code, unnest(list_append(nats, n_name)) as bare, generate_subscripts(list_append(nats, n_name), 1) as place, len(nats) + 1 as n from l)"""


@query(f"""
with {_NATION_PATTERNS_SQL}
select false as categories, bare || case when place < n then '(?=[^a-z]|$)' else '' end as pattern, code from pats union all select true, 'of ' || bare, code from pats union all select true, 'in ' || bare, code from pats""")
def s5_country_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain, of = (actors.country_patterns(_nations(spark, sf_dir), c).select(F.lit(c).alias("categories"), "pattern", "code") for c in (False, True))
    return plain.unionByName(of)


#: RE2 has no lookahead: the oracle names the character that may follow and puts it back.
_SQL_PATTERNS = ", ".join(f"({k}, '{p.replace('(?=[^a-z]|$)', '([^a-z]|$)')}', '{c}')" for k, (p, c) in enumerate(_PATTERNS))
_TEXT_SQL = "(select p_partkey, case p_partkey % 3 when 0 then p_name when 1 then 'the ' || p_name || ' of Widget' else 'Ringish ' || p_name || ', and ' || p_name end as text from part)"


@query(rf"""
with pats(k, pattern, code) as (values {_SQL_PATTERNS}), t as (select * from {_TEXT_SQL}),
m as (select p_partkey, k, code, trim(regexp_replace(trim(case when pattern like '%(%' then regexp_replace(text, pattern, '\1', 'g') else regexp_replace(text, pattern, '', 'g') end), ' +', ' ', 'g')) as rest,
  length(regexp_extract(text, '^(.*?)(' || pattern || ')', 1)) as place from t join pats on regexp_matches(text, pattern)),
l as (select p_partkey, code, rest from m qualify row_number() over (partition by p_partkey order by length(rest), k) = 1), f as (select p_partkey, code from m qualify row_number() over (partition by p_partkey order by place, k) = 1)
select t.p_partkey, l.code as longest, coalesce(l.rest, t.text) as rest, f.code as first from t left join l using (p_partkey) left join f using (p_partkey)""")
def t2_search_nat(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, key = F.col("p_name"), F.col("p_partkey")
    made = F.when(key % 3 == 0, name).when(key % 3 == 1, F.concat(F.lit("the "), name, F.lit(" of Widget"))).otherwise(F.concat(F.lit("Ringish "), name, F.lit(", and "), name))
    texts = table(spark, sf_dir, "part").select("p_partkey", made.alias("text"))
    longest = actors.find_country(texts, _PATTERNS).withColumnRenamed("country", "longest")
    both = actors.find_country(longest.withColumnRenamed("rest", "kept"), _PATTERNS, "first")
    return both.select("p_partkey", "longest", F.col("kept").alias("rest"), F.col("country").alias("first"))


_SENTENCES_SQL = "(select l_orderkey, l_linenumber, case l_orderkey % 4 when 0 then n_name || ' and ' || p_name when 1 then 'the ' || p_name || ' of ' || n_name || ', twice the ' || p_name || ' of ' || n_name when 2 then p_name || ' of ' || n_name || 'an' else 'no ' || p_name end as text from lineitem join part on p_partkey = l_partkey join nation on n_nationkey = l_orderkey % 25)"


@query(f"""
with {_NATION_PATTERNS_SQL}, t as materialized (select * from {_SENTENCES_SQL}), numbered as (select *, row_number() over (order by ordinal, place) as k from pats),
m as materialized (select text, k, code, trim(regexp_replace(trim(replace(text, bare, '')), ' +', ' ', 'g')) as rest, strpos(text, bare) as spot
  from (select distinct text from t) join numbered on contains(text, bare) where place = n or not regexp_matches(text, bare || '[a-z]'))
select l_orderkey, l_linenumber, l.code as longest, coalesce(l.rest, t.text) as rest, f.code as first from t
left join (select * from m qualify row_number() over (partition by text order by length(rest), k) = 1) l using (text)
left join (select * from m qualify row_number() over (partition by text order by spot, k) = 1) f using (text)""")
def t2_many_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences about all items of orders, by hundreds of patterns made of nations and parts."""
    patterns = [(r.pattern, r.code) for r in actors.country_patterns(_nations(spark, sf_dir)).orderBy("ordinal").collect()]  # nations times part names: a dimension
    key, part, nation = F.col("l_orderkey"), F.col("p_name"), F.col("n_name")
    of = F.concat(part, F.lit(" of "), nation)
    made = F.when(key % 4 == 0, F.concat(nation, F.lit(" and "), part)).when(key % 4 == 1, F.concat(F.lit("the "), of, F.lit(", twice the "), of)).when(key % 4 == 2, F.concat(of, F.lit("an"))).otherwise(F.concat(F.lit("no "), part))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), (key % 25).alias("n_nationkey"))
    texts = items.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey").join(F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name")), "n_nationkey").select("l_orderkey", "l_linenumber", made.alias("text"))
    longest = actors.find_country(texts, patterns).withColumnsRenamed({"country": "longest", "rest": "kept"})
    return actors.find_country(longest, patterns, "first").select("l_orderkey", "l_linenumber", "longest", F.col("kept").alias("rest"), F.col("country").alias("first"))


_LINES = ["# comment", "", "!macro! = x", "POLICE_CHIEF [~COP]", "deputy_!minist!_of_war {note} [~GOVMIL] # why", "market_!person! [BUS]", "no code here", "court [~JUD] {n}"]


@query("""
select p_partkey, x.* from part, (values ('police chief', 'COP', ''), ('Deputy Minister Of War', 'GOV', 'MIL'), ('Deputy Ministers Of War', 'GOV', 'MIL'), ('Deputy Ministry Of War', 'GOV', 'MIL'), ('Deputy Ministries Of War', 'GOV', 'MIL'),
 ('market person', 'BUS', ''), ('market man', 'BUS', ''), ('market woman', 'BUS', ''), ('market men', 'BUS', ''), ('market women', 'BUS', ''), ('court', 'JUD', '')) x(pattern, code_1, code_2)""")
def t13_s7_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "part").select("p_partkey")
    lines = keys.select(F.col("p_partkey").alias("line"), F.explode(F.array(*map(F.lit, _LINES))).alias("value"))
    return actors.parse_agents(lines).withColumnRenamed("line", "p_partkey")


@query("""
with s as (select q.vec_id as query_id, a.vec_id as pattern_id, list_cosine_similarity(q.embedding::double[], a.embedding::double[]) as conf from embeddings q, embeddings a where q.vec_id >= 50 and a.vec_id < 50)
select query_id, arg_max(pattern_id, (conf, -pattern_id)) as pattern_id, round(max(conf), 6) as conf from s group by query_id having max(conf) >= 0.3""")
def t11_agent_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = table(spark, sf_dir, "embeddings")
    found = actors.best_agent(vecs.where("vec_id >= 50").withColumnRenamed("vec_id", "query_id"), vecs.where("vec_id < 50").withColumnRenamed("vec_id", "pattern_id"), 0.3)
    return found.select("query_id", "pattern_id", F.round("conf", 6).alias("conf"))


@query("""
with v as (select vec_id, embedding::double[] as e from embeddings), s as (select q.vec_id as query_id, a.vec_id, list_cosine_similarity(q.e, a.e) as similarity from v q, v a where q.vec_id % 100 = 0)
select query_id, vec_id, row_number() over (partition by query_id order by round(similarity, 9) desc, vec_id)::int as rank, round(similarity, 6) as similarity from s
qualify row_number() over (partition by query_id order by round(similarity, 9) desc, vec_id) <= 10""")
def t11_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of all vectors to each whose id is divisible by 100, by the index and then by its bounds, so that none is missed."""
    vecs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    keep = lambda df: checkpointed(df, scratch(spark))
    found = vector_index.nearest(vecs.where("id % 100 = 0").withColumnRenamed("id", "query_id"), vector_index.build_index(vecs, keep=keep), 10, exact=True, keep=keep)
    return found.select("query_id", F.col("id").alias("vec_id"), "rank", F.round("similarity", 6).alias("similarity"))


_NAME = "case when c_custkey % 2 = 0 then lower(c_mktsegment) else c_mktsegment end"


@query(f"select c_custkey, coalesce((c_acctbal / 10000 > 0.6 and c_nationkey % 2 = 0) or (c_acctbal / 10000 > 0.9 and lower({_NAME}) = {_NAME}) or c_acctbal / 10000 > 0.95, false) as accepted from customer")
def t12_accept_directly(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", actors.accept_directly(F.col("c_acctbal") / 10000, F.col("c_nationkey") % 2 == 1, name).alias("accepted"))


_OFFICES_SQL = """(select o_custkey, o_orderkey, o_orderstatus as office, o_orderdate::date as s, lead(o_orderdate::date) over (partition by o_custkey order by o_orderdate, o_orderkey) as e from orders)"""


@query(f"""
select o_custkey, count(*) as offices, count(*) filter (where s < date '1998-06-15' and (e is null or e > date '1998-06-15')) as active,
 coalesce(list_sort(list(office) filter (where s < date '1998-06-15' and (e is null or e > date '1998-06-15'))), []) as held,
 case when count(*) filter (where s < date '1998-06-15' and (e is null or e > date '1998-06-15')) = 0 and bool_or(office = 'F') then 'ELI' end as former from {_OFFICES_SQL} group by o_custkey""")
def t17_t18_t19_offices(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    after = F.lead(F.col("o_orderdate").cast("date")).over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    held = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("s"), after.alias("e"))
    n = F.col("o_orderkey").cast("string")
    entry = lambda key, value: F.struct(F.concat(F.lit(key), n).alias("key"), value.cast("string").alias("value"))
    end_key = F.when(F.col("o_orderkey") % 2 == 0, "term_end").otherwise("termend")
    rows = held.select("o_custkey", F.explode(F.array_compact(F.array(entry("office", F.col("o_orderstatus")), entry("term_start", F.col("s")), F.when(F.col("e").isNotNull(), F.struct(F.concat(end_key, n).alias("key"), F.col("e").cast("string").alias("value")))))).alias("kv"))
    boxes = rows.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list("kv")).alias("infobox")).withColumn("offices", actors.parse_offices(F.col("infobox")))
    when = F.to_date(F.lit("1998-06-15"))
    active = actors.active_offices(F.col("offices"), when)
    codes = F.transform("offices", lambda o: F.when(o["office"] == "F", "GOV").otherwise("CVL"))
    former = actors.former_official(F.col("offices"), codes, F.transform("offices", lambda o: o["office"]), F.array(F.lit("X")), when)
    return boxes.select("o_custkey", F.size("offices").cast("long").alias("offices"), F.size(active).cast("long").alias("active"), F.array_sort(F.transform(active, lambda o: o["office"])).alias("held"), former["code_1"].alias("former"))


_VOTES_SQL = "(select user_id, event_id, case event_type when 'signup' then null when 'error' then '' else event_type end as country from events)"


@query(f"select user_id, arg_max(country, (n, -seen)) as country, max(n) as n from (select user_id, country, count(*) as n, min(event_id) as seen from {_VOTES_SQL} where country <> '' group by 1, 2) group by user_id")
def a1_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = F.when(F.col("event_type") == "signup", None).when(F.col("event_type") == "error", "").otherwise(F.col("event_type"))
    return actors.majority(table(spark, sf_dir, "events").select("user_id", "event_id", country.alias("country")), ["user_id"], "country", "event_id")


@query("""
select user_id as actor, coalesce(list_sort(list_distinct(list(event_type) filter (where event_type not in ('view')))), []) as all_code1s, list_sort(list_distinct(list((event_id % 3)::varchar))) as all_code2s, list_sort(list_distinct(list((event_id % 2)::varchar))) as countries from events group by user_id""")
def a3_code_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "events").select(F.col("user_id").alias("actor"), F.when(F.col("event_type") == "view", "IGO").otherwise(F.col("event_type")).alias("code_1"), (F.col("event_id") % 3).cast("string").alias("code_2"), (F.col("event_id") % 2).cast("string").alias("country"))
    return actors.spread_codes(codes)


@query("""
with codes as (select o_custkey as article, o_orderkey as pos, o_orderstatus as code_1, case when o_orderkey % 3 = 0 then substr(o_orderpriority, 1, 1) else '' end as country from orders where o_custkey % 3 > 0),
extra as (select c_custkey as article, c_nationkey::bigint as pos, c_mktsegment as country from customer where c_custkey % 5 > 0),
votes as (select article, pos, country from codes union all select article, pos + 1000000, country from extra),
counts as (select article, country, count(*) as n, min(pos) as seen from votes where country <> '' group by 1, 2),
known as (select article, arg_max(country, (n, -seen)) as top, count(*) as different from counts group by 1)
select article, pos, code_1, case when different = 1 then top when country = '' then top else country end as country from codes left join known using (article)
union all select article, 0, '', top from known where article not in (select article from codes)""")
def t20_article_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_custkey % 3 > 0")
    codes = orders.select(F.col("o_custkey").alias("article"), F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("code_1"), F.when(F.col("o_orderkey") % 3 == 0, F.substring("o_orderpriority", 1, 1)).otherwise("").alias("country"), F.lit("Infobox").alias("source"))
    extra = table(spark, sf_dir, "customer").where("c_custkey % 5 > 0").select(F.col("c_custkey").alias("article"), F.col("c_nationkey").cast("long").alias("pos"), F.col("c_mktsegment").alias("country"))
    return actors.article_codes(codes, extra).select("article", "pos", "code_1", "country")


_CODES = """(select user_id as actor, event_id as pos, case event_type when 'view' then 'GOV' when 'click' then 'MIL' when 'error' then '' when 'signup' then 'IGO' else 'CVL' end as code_1,
 case when event_id % 4 = 0 then 'C' || (event_id % 3) else '' end as country, case when user_id % 4 < 2 and event_id % 11 > 0 then 'Direct match' when event_id % 6 = 0 then 'Infobox' when event_id % 6 = 1 then 'Wiki short description' when event_id % 6 = 2 then 'Infobox Type' when event_id % 6 = 3 then 'BERT matching on non-entity text' else 'Direct match' end as source,
 case when event_id % 12 = 2 then 'settlement' else 'q' end as query, value as conf, (event_id % 5)::int as office_num, case when event_id % 2 = 0 and user_id % 3 > 0 then 'w' || event_id else '' end as wiki from events
 union all select 1000000 + c_custkey, c_custkey, 'GOV', '', 'Direct match', 'q', 0.5, 0, '' from customer where c_custkey % 2 = 0)"""
_KNOWN = "(select distinct user_id as actor, case when user_id % 4 = 0 then 'K' || (user_id % 2) else '' end as country from events union all select 1000000 + c_custkey, case when c_custkey % 3 > 0 then 'N' || c_nationkey else '' end from customer)"


@query(f"""
with codes as {_CODES}, known as {_KNOWN},
votes as (select actor, pos, country from codes union all select actor, 1 << 30, country from known),
counts as (select actor, country, count(*) as n, min(pos) as seen from votes where country <> '' group by 1, 2), top as (select actor, arg_max(country, (n, -seen)) as top, count(*) as different from counts group by 1),
p as (select *, case code_1 when 'IGO' then 200 when 'GOV' then 100 when 'MIL' then 80 when 'CVL' then 10 else 0 end as prio, source = 'BERT matching on non-entity text' and country <> '' and code_1 <> '' as looked from codes),
g as (select actor, count(*) as n, count(*) filter (where source = 'Infobox') as boxes, count(distinct code_1) filter (where code_1 <> '') as roles, count(*) filter (where code_1 <> '' and wiki <> '') as wiki_roles, count(*) filter (where source = 'Wiki short description') as sd,
  count(*) filter (where looked) as lookups, count(distinct country || '|' || code_1) filter (where looked) as different_lookups, arg_min(pos, pos) filter (where looked) as look_pos,
  arg_min(pos, pos) filter (where source in ('Infobox Type', 'Infobox Title')) as box_pos, arg_min(query, pos) filter (where source in ('Infobox Type', 'Infobox Title')) as box_query, arg_min(pos, pos) as any_pos,
  arg_min(pos, (office_num, pos)) filter (where source = 'Infobox') as office_pos, arg_min(pos, pos) filter (where code_1 <> '' and wiki <> '') as wiki_pos, arg_min(pos, (-conf, pos)) filter (where code_1 <> '') as conf_pos,
  arg_min(pos, pos) filter (where source = 'Wiki short description') as sd_pos, arg_min(pos, (-prio, (wiki = '')::int, pos)) as prio_pos, arg_min(wiki, (-prio, (wiki = '')::int, pos)) as prio_wiki, arg_min(wiki, pos) filter (where wiki <> '') as first_wiki from p group by actor),
r as (select *, case when n = 1 then 'only one code' when box_query = 'settlement' then 'It''s a city/settlement, so no code1 applies' when boxes = 1 then 'Only one entry in the info box' when boxes > 1 then 'Picking highest priority Wiki info box title'
   when roles = 1 and wiki_roles > 0 then 'only one unique code1, returning wiki code' when roles = 1 then 'only one unique code1: returning highest conf' when sd > 0 then 'Picking Wiki short description'
   when lookups = 1 then 'Using pre-wiki lookup' when lookups > 1 and different_lookups = 1 then 'All pre-wiki lookups are the same' when prio_wiki <> '' then 'Ranked by code1 priority, returning wiki code' else 'Ranked by code1 priority, returning first' end as reason from g),
c as (select actor, reason, first_wiki, case reason when 'only one code' then any_pos when 'It''s a city/settlement, so no code1 applies' then box_pos when 'Only one entry in the info box' then office_pos when 'Picking highest priority Wiki info box title' then office_pos
   when 'only one unique code1, returning wiki code' then wiki_pos when 'only one unique code1: returning highest conf' then conf_pos when 'Picking Wiki short description' then sd_pos when 'Using pre-wiki lookup' then look_pos when 'All pre-wiki lookups are the same' then look_pos else prio_pos end as pos from r),
b as (select actor, case when different = 1 then top when k.country <> '' then k.country else coalesce(top, '') end as best, k.country as known from known k left join top using (actor))
select b.actor, case when reason = 'It''s a city/settlement, so no code1 applies' then '' else coalesce(p.code_1, '') end as code_1,
 case when reason is null then known when reason in ('only one code', 'It''s a city/settlement, so no code1 applies') then case when p.country <> '' then p.country when reason = 'only one code' then known else best end
  when reason in ('Only one entry in the info box', 'Picking highest priority Wiki info box title', 'Picking Wiki short description') and p.code_1 = 'IGO' then 'IGO' else best end as country,
 coalesce(source, 'country only') as source, coalesce(case when p.wiki <> '' then p.wiki end, first_wiki, '') as wiki, coalesce(reason, '') as best_reason
from b left join c using (actor) left join p on p.actor = c.actor and p.pos = c.pos where reason is not null or known <> ''""")
def t21_pick_best_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, kind, user = F.col("event_id"), F.col("event_type"), F.col("user_id")
    rows = table(spark, sf_dir, "events")
    source = F.when((user % 4 < 2) & (e % 11 > 0), "Direct match").when(e % 6 == 0, "Infobox").when(e % 6 == 1, "Wiki short description").when(e % 6 == 2, "Infobox Type").when(e % 6 == 3, "BERT matching on non-entity text").otherwise("Direct match")
    codes = rows.select(
        user.alias("actor"), e.alias("pos"), F.when(kind == "view", "GOV").when(kind == "click", "MIL").when(kind == "error", "").when(kind == "signup", "IGO").otherwise("CVL").alias("code_1"), F.lit("").alias("code_2"),
        F.when(e % 4 == 0, F.concat(F.lit("C"), (e % 3).cast("string"))).otherwise("").alias("country"), source.alias("source"),
        F.when(e % 12 == 2, "settlement").otherwise("q").alias("query"), F.col("value").alias("conf"), (e % 5).cast("int").alias("office_num"), F.when((e % 2 == 0) & (user % 3 > 0), F.concat(F.lit("w"), e.cast("string"))).otherwise("").alias("wiki"),
    )
    customers, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    single = customers.where(key % 2 == 0).select((1_000_000 + key).alias("actor"), key.alias("pos"), F.lit("GOV").alias("code_1"), F.lit("").alias("code_2"), F.lit("").alias("country"), F.lit("Direct match").alias("source"), F.lit("q").alias("query"), F.lit(0.5).alias("conf"), F.lit(0).alias("office_num"), F.lit("").alias("wiki"))
    known = rows.select(user.alias("actor"), F.when(user % 4 == 0, F.concat(F.lit("K"), (user % 2).cast("string"))).otherwise("").alias("country")).distinct()
    known = known.unionByName(customers.select((1_000_000 + key).alias("actor"), F.when(key % 3 > 0, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).otherwise("").alias("country")))
    return actors.pick_best_code(codes.unionByName(single), known).select("actor", "code_1", "country", "source", "wiki", "best_reason")


@query("""
with c as (select event_id, case event_id % 6 when 0 then 'JNK' when 1 then 'NON' when 2 then 'IGO' when 3 then 'GOV' when 4 then '' else 'UNO' end as code_1, case event_id % 5 when 0 then 'UKRPRE' when 1 then null when 2 then 'USA' when 3 then '' else 'SOMPRE' end as country from events),
d as (select event_id, code_1 as old, case when code_1 in ('JNK', 'NON') then '' when code_1 in ('IGO', 'MNC', 'NGO', 'ISM', 'EUR', 'UNO') then code_1 else coalesce(country, '') end as country from c)
select event_id, case when length(country) = 6 then substr(country, 4, 3) when old in ('IGO', 'MNC', 'NGO', 'ISM', 'EUR', 'UNO') then '' else old end as code_1, case when length(country) = 6 then substr(country, 1, 3) else country end as country from d""")
def t22_clean_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    code = F.element_at(F.array(*map(F.lit, ["JNK", "NON", "IGO", "GOV", "", "UNO"])), (e % 6 + 1).cast("int"))
    country = F.element_at(F.array(*map(F.lit, ["UKRPRE", None, "USA", "", "SOMPRE"])), (e % 5 + 1).cast("int"))
    return actors.clean_best(table(spark, sf_dir, "events").select("event_id", code.alias("code_1"), country.alias("country"))).select("event_id", "code_1", "country")


@query("""
with t as (select p_brand, list({'w': w, 'n': i, 'e': length(w) % 3} order by p_partkey, i) as toks from (select p_brand, p_partkey, unnest(list_append(string_split(p_name, ' '), 'the')) as w, unnest([1, 2, 3]) as i from part) group by p_brand)
select p_brand, trim(array_to_string(list_transform(list_filter(toks, lambda t: t.e > 0 and t.w <> 'the'), lambda t: t.w || ' '), '')) as kept from t""")
def f5_strip_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "part").select("p_brand", "p_partkey", F.posexplode(F.concat(F.split("p_name", " "), F.array(F.lit("the")))).alias("i", "text"))
    token = F.struct("p_partkey", "i", "text", F.lit(" ").alias("ws"), F.when(F.length("text") % 3 == 0, "ORG").otherwise("").alias("ent_type"))
    return words.groupBy("p_brand").agg(F.array_sort(F.collect_list(token)).alias("tokens")).select("p_brand", actors.strip_entities(F.col("tokens")).alias("kept"))


@query("""
select p_partkey, case when p_partkey % 2 = 0 then [lower(p_name)] else [] end as phrases from part""")
def f6_noun_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.concat(F.array(F.lit("the")), F.split("p_name", " "), F.array(F.lit("seven")))
    ent = lambda w: F.when(w == "seven", F.lit("CARDINAL")).otherwise("")
    chunk = F.transform(words, lambda w: F.struct(w.alias("text"), F.lit(" ").alias("ws"), ent(w).alias("ent_type")))
    last = F.when(F.col("p_partkey") % 2 == 0, "").otherwise("ORG")
    chunk = F.concat(chunk, F.array(F.struct(F.lit("and").alias("text"), F.lit(" ").alias("ws"), last.alias("ent_type"))))
    return table(spark, sf_dir, "part").select("p_partkey", actors.noun_phrases(F.array(chunk)).alias("phrases"))


@query("""
select p_partkey, upper(substr(p_name, 1, 1)) || upper(substr(split_part(p_name, ' ', 2), 1, 1)) as initials,
 upper(substr(p_name, 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' of ' || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) as expanded, 'United Nations' as un from part""")
def t15_t16_query_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (F.initcap(F.split_part("p_name", F.lit(" "), F.lit(k))) for k in (1, 2))
    words = F.array(F.struct(a.alias("text"), F.lit("PROPN").alias("pos")), F.struct(F.lit("of").alias("text"), F.lit("ADP").alias("pos")), F.struct(b.alias("text"), F.lit("PROPN").alias("pos")))
    full = F.concat(a, F.lit(" of "), b)
    ents = F.array(F.struct(full.alias("text"), F.lit("ORG").alias("label"), words.alias("words")), F.struct(F.upper(full).alias("text"), F.lit("ORG").alias("label"), words.alias("words")))
    initials = F.concat(F.substring(a, 1, 1), F.substring(b, 1, 1))
    rows = table(spark, sf_dir, "part").select("p_partkey", initials.alias("initials"), actors.acronyms(ents).alias("known"))
    none = F.expr("cast(array() as array<string>)")
    return rows.select("p_partkey", "initials", actors.expand_query(F.col("initials"), none, F.col("known")).alias("expanded"), F.try_element_at("known", F.lit("UN")).alias("un"))


@query("select o_orderkey, 'r' || o_orderstatus as resolved from orders")
def t31_resolve_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("text"))
    return actors.resolve_once(mentions, ["text"], lambda d: d.withColumn("resolved", F.concat(F.lit("r"), "text"))).select("o_orderkey", "resolved")


@query("""
select s_suppkey, case when s_suppkey % 5 in (1, 4) then 'UN' else s_name end as core_entity, n_name as geographic_info,
 case s_suppkey % 5 when 0 then 'minister' when 1 then 'official' when 2 then 'right-wing leader party' when 3 then n_name || 'ian airport chief' else 'council' end as role from supplier join nation on s_nationkey = n_nationkey""")
def t14_entity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of all suppliers: a place before a role, a possessive, words that a role takes over, a place inside a longer word, a role after an organization."""
    k, name, nation = F.col("s_suppkey") % 5, F.col("s_name"), F.col("n_name")
    person, place = F.struct(name.alias("text"), F.lit("PERSON").alias("label")), F.struct(nation.alias("text"), F.lit("GPE").alias("label"))
    text = (
        F.when(k == 0, F.concat(nation, F.lit(" minister "), name))
        .when(k == 1, F.concat(nation, F.lit("'s UN official")))
        .when(k == 2, F.concat(F.lit("right-wing leader "), name, F.lit(" of the "), nation, F.lit(" Party")))
        .when(k == 3, F.concat(nation, F.lit("ian airport chief "), name, F.lit(" of "), nation))
        .otherwise(F.concat(nation, F.lit(" UN council")))
    )
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.select("s_suppkey", text.alias("text"), F.when(k.isin(1, 4), F.array(place)).otherwise(F.array(place, person)).alias("ents"), F.lit(None).cast("array<string>").alias("appositives"))
    return mentions.split_mentions(rows).select("s_suppkey", "core_entity", "geographic_info", "role")


@query("select p_partkey, p_name || ' ' || p_type || ', ' || p_brand as shown from part")
def p7_ranking_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit("\nmore")).alias("title"), F.lit(None).cast("string").alias("intro"), F.array("p_type", "p_brand").alias("names"))
    return rows.select("p_partkey", mentions.ranking_text(rows, ["title", "intro", "names"]).alias("shown"))
