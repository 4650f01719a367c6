"""Retrieval, candidate scoring and ranking, knowledge-base building."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import knowledge, pairs, ranking, retrieval
from eventloom.operators.retrieval import Field
from eventloom.plans.registry import query, scratch, table
from eventloom.sources.sinks import checkpointed

_FIELDS = retrieval.DEFAULT_FIELDS + [f for f in retrieval.REQUIRED_FIELDS if f.whole]


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: the first line is the title, language and source are redirects and categories."""
    line = F.split("text", "\n")[0]
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("article_id"), line.alias("title"), F.array("lang", "source").alias("redirects"), F.array(F.substring_index(line, " ", 2), F.col("lang")).alias("alternative_names"),
        F.substring("text", 1, 80).alias("short_desc"), F.col("text").alias("intro_para"), F.array("source", F.concat("lang", F.lit("/"), "source")).alias("categories"), F.array(F.concat(F.lit("lang="), "lang")).alias("infobox"),
    )


def _index(spark: SparkSession, sf_dir: str) -> retrieval.Index:
    path = scratch(spark)
    retrieval.write_index(retrieval.build_index(_articles(spark, sf_dir), _FIELDS), path)
    return retrieval.read_index(spark, path)


def _keep(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    return lambda df: checkpointed(df, scratch(spark))


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a source's name behind them; every fourth is that name alone, which is an exact word of articles."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.when(F.col("item_id") % 4 == 0, "src3").otherwise(F.concat("text", F.lit(" src3"))).alias("query"))


_INDEX_SQL = r"""
articles as (select doc_id as article_id, string_split(text, chr(10))[1] as title, lang, source, text from documents),
fields as (select article_id, 'title' as field, title as t from articles union all select article_id, 'redirects', lang || ' ' || source from articles
 union all select article_id, 'alternative_names', array_to_string(list_slice(string_split(title, ' '), 1, 2), ' ') || ' ' || lang from articles union all select article_id, 'intro_para', text from articles union all select article_id, 'short_desc', substr(text, 1, 80) from articles),
toks as (select article_id, field, unnest(list_filter(regexp_split_to_array(lower(t), '[^\pL\pN]+'), lambda x: x <> '')) as token from fields
 union all select article_id, 'categories', unnest([source, lang || '/' || source]) from articles union all select article_id, 'infobox', 'lang=' || lang from articles),
postings as (select field, token, article_id, count(*) as tf from toks group by all), lengths as (select field, article_id, sum(tf) as len from postings group by all),
dfs as (select field, token, count(*) as df from postings group by all), totals as (select field, count(*) as n, avg(len) as mean_len from lengths group by all),
q as (select item_id as query_id, case when item_id % 4 = 0 then 'src3' else text || ' src3' end as query from benchmark),
boosts(field, boost, exact) as (values ('title', 50, 250), ('redirects', 50, 100), ('alternative_names', 20, 100), ('intro_para', 5, 0), ('short_desc', 10, 0)),
limits(field, boost, whole) as (values ('title', 100, false), ('redirects', 100, false), ('alternative_names', 1, false), ('intro_para', 1, false), ('categories', 1, true), ('infobox', 1, true)),
qtoks as (select query_id, query, unnest(list_distinct(list_filter(regexp_split_to_array(lower(query), '[^\pL\pN]+'), lambda x: x <> ''))) as token from q),
clauses as (select query_id, field, token, boost, false as required from qtoks, boosts union all select query_id, field, query, exact, false from q, boosts where exact > 0{required}),
parts as (select c.query_id, c.required, p.field, p.token, c.boost, p.article_id, case when p.field = 'redirects' then 1 else ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * case when p.field in ('categories', 'infobox') then 1 else 1 - 0.75 + 0.75 * len / mean_len end) end as part
  from clauses c join postings p on c.field = p.field and c.token = p.token join dfs on dfs.field = p.field and dfs.token = p.token join totals on totals.field = p.field join lengths on lengths.field = p.field and lengths.article_id = p.article_id),
scored as (select query_id, article_id, sum(boost * part) as score, bool_or(required) as held, bool_and(required) as alone from parts group by all)"""
_BASE_SQL = _INDEX_SQL.replace("{required}", "")
_REQUIRED_SQL = _INDEX_SQL.replace("{required}", " union all select query_id, field, word, boost, true from q, limits, (values (false, 'lang'), (false, 'en'), (true, 'lang=en')) v(v, word) where v = whole")


@query(f"with {_BASE_SQL} select query_id, article_id, round(score, 4) as score from scored qualify row_number() over (partition by query_id order by round(score, 9) desc, article_id) <= 10")
def r1_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = retrieval.search(_queries(spark, sf_dir), _index(spark, sf_dir), retrieval.DEFAULT_FIELDS, k=10, keep=_keep(spark))
    return hits.select("query_id", "article_id", F.round("score", 4).alias("score"))


@query(f"with {_BASE_SQL} select query_id, article_id, round(score, 4) as score from scored qualify row_number() over (partition by query_id order by round(score, 9) desc, article_id) <= 10")
def r1_bounded_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search by bounds, however few postings there are."""
    hits = retrieval.search(_queries(spark, sf_dir), _index(spark, sf_dir), retrieval.DEFAULT_FIELDS, k=10, keep=_keep(spark), few=0)
    return hits.select("query_id", "article_id", F.round("score", 4).alias("score"))


@query(f"with {_REQUIRED_SQL} select query_id, article_id, round(score, 4) as score from scored where held and not alone qualify row_number() over (partition by query_id order by round(score, 9) desc, article_id) <= 5")
def r2_search_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = _queries(spark, sf_dir)
    required = queries.select("query_id", F.lit("lang=en").alias("term"))
    hits = retrieval.search(queries, _index(spark, sf_dir), retrieval.DEFAULT_FIELDS, k=5, required=required, keep=_keep(spark))
    return hits.select("query_id", "article_id", F.round("score", 4).alias("score"))


@query("select p_partkey, (case when p_partkey % 25 >= 5 then 5 else 0 end + case when p_partkey % 25 >= 10 then 30 else 0 end + case when p_partkey % 25 >= 20 then 100 else 0 end + case when p_size % 12 >= 5 then 3 else 0 end + case when p_size % 12 >= 10 then 50 else 0 end + case when p_size % 7 >= 2 then 2 else 0 end + case when p_size % 7 >= 5 then 10 else 0 end + case when p_partkey % 2 = 0 then 3 else 0 end + case when p_partkey % 3 > 0 then 2 else 0 end)::double as bonus from part")
def r4_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    many = lambda n: F.array_repeat(F.lit("x"), n.cast("int"))
    key, size = F.col("p_partkey"), F.col("p_size")
    box = F.when(key % 2 == 0, F.create_map(F.lit("name"), F.col("p_name")))
    bonus = retrieval.importance_bonus(many(key % 25), many(size % 12), many(size % 7), box, F.when(key % 3 > 0, F.col("p_name")))
    return table(spark, sf_dir, "part").select("p_partkey", bonus.alias("bonus"))


#: Settings of a search by name: the boosts of title and introduction.
_BOOSTS = [("default", 50, 5), ("flat", 25, 25), ("intro only", 0, 5)]


@query(f"""with {_BASE_SQL}, gold as (select item_id as query_id, min(doc_id) as article_id from benchmark b left join documents d on contains(d.text, b.text) group by 1),
settings(setting, t, i) as (values ('default', 50, 5), ('flat', 25, 25), ('intro only', 0, 5)),
tried as (select setting, query_id, article_id, sum(part * case field when 'title' then t else i end) as score from parts, settings where field in ('title', 'intro_para') and boost in (50, 5) group by all),
ranked as (select *, row_number() over (partition by setting, query_id order by round(score, 9) desc, article_id) as rank from tried)
select setting, k, avg((gold.article_id is null or coalesce(rank <= k, false))::int) as recall from settings cross join gold left join ranked using (setting, query_id, article_id), (values (1), (5), (50)) c(k) group by setting, k""")
def m5_boost_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall of each setting of the boosts at each k, over one written index."""
    index, queries = _index(spark, sf_dir), _queries(spark, sf_dir)
    gold = _keep(spark)(_gold(spark, sf_dir))
    found = None
    for name, title, intro in _BOOSTS:
        hits = retrieval.search(queries, index, [Field("title", title), Field("intro_para", intro)], k=50, keep=_keep(spark))
        recall = retrieval.recall_at(hits, gold, [1, 5, 50]).select(F.lit(name).alias("setting"), "k", "recall")
        found = recall if found is None else found.unionByName(recall)
    return found


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("item"))
    found = pairs.containing(items, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return items.select("query_id").join(found.groupBy("query_id").agg(F.min("doc_id").alias("article_id")), "query_id", "left")


@query(f"""with {_BASE_SQL}, ranked as (select query_id, article_id, row_number() over (partition by query_id order by round(score, 9) desc, article_id) as rank from scored),
gold as (select item_id as query_id, min(doc_id) as article_id from benchmark b left join documents d on contains(d.text, b.text) group by 1)
select k, avg((gold.article_id is null or coalesce(rank <= k, false))::int) as recall from gold left join ranked using (query_id, article_id), (values (1), (5), (50)) c(k) group by k""")
def r3_a11_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = retrieval.search(_queries(spark, sf_dir), _index(spark, sf_dir), retrieval.DEFAULT_FIELDS, k=50, keep=_keep(spark))
    return retrieval.recall_at(hits, _gold(spark, sf_dir), [1, 5, 50])


_MADE = "case page_id % 9 when 0 then 'Talk:' || t when 1 then t || ' disambiguation' when 2 then 'User:' || t when 3 then 'x Category:' || t when 4 then 'Category:' || t else t end"
_INTRO = "case page_id % 11 when 0 then '' when 1 then t || ' may refer to' when 2 then 'short' when 3 then t || repeat(' filler', 9) || ' usually refers to' when 4 then 'Category: ' || h else h end"
_PAGES_SQL = f"(select page_id, {_MADE} as title, {_INTRO} as intro from (select page_id, substr(regexp_extract(html, '<title>(.*?)</title>', 1), 1, 20) as t, html as h from pages))"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    t, h = F.substring(F.regexp_extract("html", "<title>(.*?)</title>", 1), 1, 20), F.col("html")
    title = F.when(p % 9 == 0, F.concat(F.lit("Talk:"), t)).when(p % 9 == 1, F.concat(t, F.lit(" disambiguation"))).when(p % 9 == 2, F.concat(F.lit("User:"), t)).when(p % 9 == 3, F.concat(F.lit("x Category:"), t)).when(p % 9 == 4, F.concat(F.lit("Category:"), t)).otherwise(t)
    intro = F.when(p % 11 == 0, "").when(p % 11 == 1, F.concat(t, F.lit(" may refer to"))).when(p % 11 == 2, "short").when(p % 11 == 3, F.concat(t, F.lit(" filler" * 9 + " usually refers to"))).when(p % 11 == 4, F.concat(F.lit("Category: "), h)).otherwise(h)
    return table(spark, sf_dir, "pages").select("page_id", title.alias("title"), intro.alias("intro"))


@query(f"""select page_id, title from {_PAGES_SQL} where not regexp_matches(title, '(stub|User|Wikipedia):') and not regexp_matches(title, '^(Wikipedia|Talk|Template|Category|Portal):') and not contains(title, 'disambiguation')
 and not regexp_matches(substr(intro, 1, 50), 'Category:|is the name of|may refer to|can refer to|most commonly refers to|is a surname') and not contains(substr(intro, 1, 40), 'is used as an abbreviation for')
 and not regexp_matches(substr(intro, 1, 80), 'usually refers to|may stand for') and length(intro) > 50""")
def f1_good_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).where(retrieval.good_article(F.col("title"), F.col("intro"))).select("page_id", "title")


_TITLES = ["a.jpg", "b.png", "x-stub", "User x", "Selected anniversaries", "M (disambiguation)", "Articles for deletion", "List of", "Portal x", "Peer review/x", "Requests for adminship/x", "Featured list candidates/x", "Sockpuppet investigations/x", "", "On Peer review/x", "The List of", "a Portal x", "x Sockpuppet investigations/", "Categories for", "a.jpg file", "plain"]
_INTROS = ["", "#REDIRECT [[A]]", "redirect to", "It is in Category: x", "<noinclude>", "It may refer to", "x portal: y", "see <noinclude>", "#ReDirect", "a redirect", "text"]
_ADMITTED = r"""
with t as (select page_id, list_extract({titles}, (page_id % {n} + 1)::int) as title, list_extract({intros}, (page_id % {m} + 1)::int) as intro from pages)
select page_id, title <> '' and not regexp_matches(title, '\.(jpg|png)$|-stub|^(User|Selected anniversaries)|\([Dd]isambiguation\)|Articles for deletion|^List |^Portal |Today''s featured article|Featured article candidates|^Peer review/|^Requests for adminship/|^Featured list candidates/|^Sockpuppet investigations/') as title_ok,
 intro <> '' and not regexp_matches(intro, '^#?(REDIRECT|redirect|Redirect)|Category:|^<noinclude>') and not regexp_matches(substr(intro, 1, 100), 'may refer to|most often refers|most commonly refers|[Pp]ortal:') as intro_ok from t"""


@query(_ADMITTED.format(titles=_TITLES, n=len(_TITLES), intros=_INTROS, m=len(_INTROS)))
def f2_f3_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.element_at(F.array(*map(F.lit, _TITLES)), (F.col("page_id") % len(_TITLES) + 1).cast("int"))
    intro = F.element_at(F.array(*map(F.lit, _INTROS)), (F.col("page_id") % len(_INTROS) + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", knowledge.admissible_title(title).alias("title_ok"), knowledge.admissible_intro(intro).alias("intro_ok"))


@query("""
with links as (select url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as target from pages)
select target, list_sort(list_distinct(list(url))) as redirects from links group by target""")
def a4_invert_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "pages").select(F.col("url").alias("title"), F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("t"))
    return knowledge.invert_redirects(links.select("title", F.concat(F.lit("#REDIRECT [["), "t", F.lit("]]")).alias("text")))


@query("""
with r as (select case when p_partkey % 2 = 0 then p_name else upper(substr(p_name, 1, 1)) || substr(p_name, 2) end as target, list_sort(list_distinct(list(p_brand))) as redirects from part where p_partkey % 7 > 0 group by 1),
absorbed as (select distinct lower(target) as low from r where target <> lower(target)),
m as (select a.target, list_sort(list_distinct(list_concat(a.redirects, coalesce(b.redirects, [])))) as redirects from r a left join r b on a.target <> lower(a.target) and b.target = lower(a.target))
select * from m where target not in (select low from absorbed)""")
def a6_merge_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    target = F.when(F.col("p_partkey") % 2 == 0, name).otherwise(F.concat(F.upper(F.substring(name, 1, 1)), F.substr(name, F.lit(2))))
    grouped = table(spark, sf_dir, "part").where("p_partkey % 7 > 0").groupBy(target.alias("target")).agg(F.array_sort(F.collect_set("p_brand")).alias("redirects"))
    return knowledge.merge_cases(grouped)


@query("""
with r as (select p_brand as title, list_sort(list_distinct(list(p_name))) as redirects from part where p_partkey % 2 = 0 group by p_brand)
select p_partkey, coalesce(redirects, []) as redirects from (select p_partkey, case when p_partkey % 3 = 0 then 'none' else p_brand end as title from part) left join r using (title)""")
def s11_attach_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    redirects = part.where("p_partkey % 2 = 0").groupBy(F.col("p_brand").alias("target")).agg(F.array_sort(F.collect_set("p_name")).alias("redirects"))
    titles = part.select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, "none").otherwise(F.col("p_brand")).alias("title"))
    return knowledge.attach_redirects(titles, redirects).select("p_partkey", "redirects")


@query("select o_custkey::varchar as title, arg_max(o_orderkey, o_orderkey) as o_orderkey from orders group by o_custkey")
def k3_latest_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("title"), F.col("o_orderkey").alias("ordinal"), "o_orderkey")
    return knowledge.latest_by_title(rows).select("title", "o_orderkey")


_MARKUP = "{{Short description|A %s thing}}\n{{Infobox widget\n| name = %s\n| alias = x%s, y\n| founder = {{ubl|A}}\n| map = m\n}}\n'''%s''' is a [[thing|widget]] of some importance to everybody.<ref>x</ref>\n\n== History ==\nmore\n[[Category:Things]]\n[[Category: %s ]]"


@query("""
select p_partkey::varchar as title, 'A ' || p_type || ' thing' as short_desc, 'widget' as box_type, list_sort(list_distinct([p_name, 'x' || p_brand, 'y'])) as alternative_names, ['Things', p_brand] as categories, p_name || ' is a widget of some importance to everybody.' as intro_para, 3::bigint as infobox_keys,
 [(p_partkey + 1)::varchar || 'r'] as redirects from part""")
def t28_p10_p12_knowledge_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    pages = part.select(key.alias("title"), F.format_string(_MARKUP, "p_type", "p_name", "p_brand", "p_name", "p_brand").alias("text"))
    redirects = part.select(F.concat((F.col("p_partkey") + 1).cast("string"), F.lit("r")).alias("title"), F.concat(F.lit("#REDIRECT [["), key, F.lit("]]")).alias("text"))
    base = knowledge.build_knowledge_base(pages.unionByName(redirects))
    return base.select("title", "short_desc", "box_type", "alternative_names", "categories", "intro_para", F.size("infobox").cast("long").alias("infobox_keys"), "redirects")


@query("""
select p_partkey, list_sort(list_distinct([p_name, p_brand, p_type, 'Dr ' || p_type, 'mayor ' || p_type, p_type || ' Jr'])) as names from part""")
def p13_entry_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.create_map(F.lit("name"), F.col("p_type"), F.lit("prefix"), F.lit("Dr"), F.lit("office"), F.lit("mayor"), F.lit("suffix"), F.lit("Jr"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_sort(knowledge.entry_names(F.col("p_name"), F.array("p_brand"), F.lit(None).cast("array<string>"), box)).alias("names"))


_SCORES_SQL = """(select o_custkey as task, o_orderkey as article_id, (row_number() over (partition by o_custkey order by o_orderkey) - 1)::int as rank, (o_orderkey % 7 = 0)::int as exact_title_match, (o_orderkey % 5 = 0)::int as redirect_match, (o_orderkey % 3 = 0)::int as alt_name_match,
 (o_orderkey % 2)::int as country_match, (o_orderkey % 101) / 100.0 as title_sim, (o_orderkey % 97) / 96.0 as context_sim_intro, (o_orderkey % 11) / 50.0 as context_sim_short, (o_orderkey % 13) / 50.0 as actor_desc_sim_intro, 0.0 as actor_desc_sim_short,
 (o_orderkey % 9)::int as alt_names_count, (o_orderkey % 500)::int as intro_length, o_custkey % 2 = 0 as has_context from orders)"""


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    k = F.col("o_orderkey")
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    flag = lambda n: (k % n == 0).cast("int")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("task"), k.alias("article_id"), rank.alias("rank"), flag(7).alias("exact_title_match"), flag(5).alias("redirect_match"), flag(3).alias("alt_name_match"), (k % 2).cast("int").alias("country_match"),
        ((k % 101) / 100.0).alias("title_sim"), ((k % 97) / 96.0).alias("context_sim_intro"), ((k % 11) / 50.0).alias("context_sim_short"), ((k % 13) / 50.0).alias("actor_desc_sim_intro"), F.lit(0.0).alias("actor_desc_sim_short"),
        (k % 9).cast("int").alias("alt_names_count"), (k % 500).cast("int").alias("intro_length"), (F.col("o_custkey") % 2 == 0).alias("has_context"),
    )


@query(f"""
select task, article_id, round(10 * exact_title_match + 5 * redirect_match + 3 * alt_name_match + 2 * country_match + title_sim + 2 * (context_sim_intro + context_sim_short + actor_desc_sim_intro + actor_desc_sim_short) + 0.5 * ln(1 + alt_names_count) + 0.1 * ln(1 + intro_length), 6) as combined,
 round(title_sim / nullif(max(title_sim) over (partition by task), 0), 6) as title_sim_norm, round(alt_names_count / nullif(max(alt_names_count) over (partition by task), 0), 6) as alt_names_count_norm from {_SCORES_SQL}""")
def t27_a7_combined_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ranking.normalise(_scores(spark, sf_dir), ["title_sim", "alt_names_count"])
    return scored.select("task", "article_id", F.round(ranking.combined_score(), 6).alias("combined"), F.round("title_sim_norm", 6).alias("title_sim_norm"), F.round("alt_names_count_norm", 6).alias("alt_names_count_norm"))


@query(f"""
with s as (select *, 10 * exact_title_match + 5 * redirect_match + 3 * alt_name_match + 2 * country_match + title_sim + 2 * (context_sim_intro + context_sim_short + actor_desc_sim_intro + actor_desc_sim_short) + 0.5 * ln(1 + alt_names_count) + 0.1 * ln(1 + intro_length) as combined from {_SCORES_SQL}),
g as (select task, bool_or(has_context) as ctx, sum(exact_title_match) as ne, sum(redirect_match) as nr, sum(alt_name_match) as na,
 arg_max({{'a': article_id, 'v': context_sim_intro}}, (context_sim_intro, -rank)) filter (where exact_title_match = 1) as ec, arg_max({{'a': article_id, 'v': title_sim}}, (title_sim, -rank)) filter (where exact_title_match = 1) as et,
 arg_max({{'a': article_id, 'v': context_sim_intro}}, (context_sim_intro, -rank)) filter (where redirect_match = 1) as rc, arg_max({{'a': article_id, 'v': title_sim}}, (title_sim, -rank)) filter (where redirect_match = 1) as rt,
 arg_max({{'a': article_id, 'v': context_sim_intro}}, (context_sim_intro, -rank)) filter (where alt_name_match = 1) as ac, arg_max({{'a': article_id, 'v': context_sim_intro}}, (context_sim_intro, -rank)) as oc, arg_max({{'a': article_id, 'v': combined}}, (combined, -rank)) as ob from s group by task),
r as (select task, case when ne = 1 then {{'a': et.a, 'r': 'Single exact title match'}} when ne > 1 and ctx and ec.v > 0.5 then {{'a': ec.a, 'r': 'Best context match among exact title matches'}} when ne > 1 and et.v > 0.7 then {{'a': et.a, 'r': 'Best title similarity among exact matches'}}
 when nr = 1 then {{'a': rt.a, 'r': 'Single redirect match'}} when nr > 1 and ctx and rc.v > 0.5 then {{'a': rc.a, 'r': 'Best context match among redirect matches'}} when nr > 1 and rt.v > 0.7 then {{'a': rt.a, 'r': 'Best title similarity among redirect matches'}}
 when na > 0 and ctx and ac.v > 0.6 then {{'a': ac.a, 'r': 'Best context match among alternative name matches'}} when ctx and oc.v > 0.6 then {{'a': oc.a, 'r': 'Best overall context match'}} when ob.v > 9 then {{'a': ob.a, 'r': 'Best overall combined score'}} end as p from g)
select task, p.a as article_id, p.r as wiki_reason from r where p is not null""")
def t26_choose_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.choose_by_rules(_scores(spark, sf_dir))


@query(f"select task, arg_max(article_id, (title_sim, -rank)) as article_id, max(title_sim) as probability from {_SCORES_SQL} group by task having max(title_sim) > 0.5")
def w2_choose_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.choose_by_model(_scores(spark, sf_dir), F.col("title_sim"))


_FRAME_SQL = """(select p_brand as task, p_partkey as rank, split_part(p_name, ' ', 1) as query, p_name as title, p_type as country, p_type || ' made by ' || p_brand as intro_para, case when p_partkey % 2 = 0 then [p_type, p_name] end as names from part)"""


@query(f"""
select task, rank, (title in (query, upper(query)))::int as exact_title_match, contains(intro_para, country)::int as country_match, coalesce(len(names), 0)::int as alt_names_count, length(intro_para)::int as intro_length, count(*) over (partition by task) as num_es_results,
 round(1 - levenshtein(query, title) / greatest(length(query), length(title)), 6) as levenshtein, (row_number() over (partition by task order by 1 - levenshtein(query, title) / greatest(length(query), length(title)) desc, rank) = 1)::int as best_lev from {_FRAME_SQL}""")
def a9_a10_w3_score_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.when(F.col("p_partkey") % 2 == 0, F.array("p_type", "p_name"))
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("task"), F.col("p_partkey").alias("rank"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("query"), F.col("p_name").alias("title"), F.col("p_type").alias("country"), F.concat("p_type", F.lit(" made by "), "p_brand").alias("intro_para"), F.lit(None).cast("string").alias("short_desc"), names.alias("alternative_names"), F.lit(None).cast("array<string>").alias("redirects"), F.lit(None).cast("string").alias("infobox_name"))
    return ranking.score_candidates(rows).select("task", "rank", "exact_title_match", "country_match", "alt_names_count", "intro_length", "num_es_results", F.round("levenshtein", 6).alias("levenshtein"), "best_lev")
