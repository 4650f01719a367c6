"""String, date and vector functions over the star tables and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions import dates, text, vectors
from eventloom.operators import similar_names
from eventloom.plans.registry import query, table

#: Mentions made of customer rows: articles, ordinals, possessives and numbers around the same word.
_MENTIONS_SQL = """(select c_custkey, case c_custkey % 8 when 0 then 'The ' || c_mktsegment when 1 then 'an  ' || c_mktsegment || ' of'
 when 2 then (c_custkey % 100)::varchar || 'th ' || c_mktsegment when 3 then c_mktsegment || '''s' when 4 then '42 ' || c_name
 when 5 then 'the' when 6 then '''s a ' || chr(10) || c_name else 'x' end as text from customer)"""


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, word, name = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_name")
    case = (
        F.when(key % 8 == 0, F.concat(F.lit("The "), word))
        .when(key % 8 == 1, F.concat(F.lit("an  "), word, F.lit(" of")))
        .when(key % 8 == 2, F.concat((key % 100).cast("string"), F.lit("th "), word))
        .when(key % 8 == 3, F.concat(word, F.lit("'s")))
        .when(key % 8 == 4, F.concat(F.lit("42 "), name))
        .when(key % 8 == 5, F.lit("the"))
        .when(key % 8 == 6, F.concat(F.lit("'s a \n"), name))
        .otherwise("x")
    )
    return table(spark, sf_dir, "customer").select("c_custkey", case.alias("text"))


_CLEAN_SQL = "trim(regexp_replace(regexp_replace(text, ' +', ' ', 'g'), chr(10) || '+', ' ', 'g'))"
for _pattern, _options in [("^the ", "'i'"), ("^an ", "'i'"), ("^a ", "'i'"), (" of$", "''"), ("^''s", "''")]:
    _CLEAN_SQL = f"trim(regexp_replace({_CLEAN_SQL}, '{_pattern}', '', {_options}))"
_CLEAN_SQL = rf"trim(regexp_replace({_CLEAN_SQL}, '(\d)(st|nd|rd|th)\b', '\1', 'g'))"
_CLEAN_SQL = rf"trim(regexp_replace(trim(regexp_replace({_CLEAN_SQL}, '^\d+ ', '')), '''s$', ''))"


@query(f"select c_custkey, case when text in ('The', 'the', 'a', 'an', '') or length(q) < 2 then '' else q end as query from (select c_custkey, text, {_CLEAN_SQL} as q from {_MENTIONS_SQL})")
def t1_clean_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions(spark, sf_dir).select("c_custkey", text.clean_query(F.col("text")).alias("query"))


_LETTERS_SQL = ", ".join(f"(chr({ord(c)}), '{to.replace(chr(39), chr(39) * 2)}')" for c, to in text.transliterations().items())


@query(rf"""
with letters(c, plain) as (values {_LETTERS_SQL}), m as (select map(list(c), list(plain)) as plain from letters)
select doc_id, regexp_replace(array_to_string(list_transform(string_split(text, ''), lambda c: coalesce(plain[c], c)), ''), '\p{{Mn}}+', '', 'g') as plain from documents, m""")
def t3_fold_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.fold_texts(F.col("text")).alias("plain"))


@query(r"""
select doc_id, array_to_string(list_transform(regexp_extract_all(text, '(\pL+|[^\pL]+)'), lambda r: case when r[1] = 'ß' then 'Ss' else upper(substr(r, 1, 1)) end || lower(substr(r, 2))), '') as title from documents""")
def t4_title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.title_case(F.col("text")).alias("title"))


_CANDIDATES_SQL = """(select p_partkey, split_part(p_name, ' ', 1) as q, upper(p_type) as country,
  case p_partkey % 5 when 0 then p_name when 1 then upper(split_part(p_name, ' ', 1)) when 2 then split_part(p_name, ' ', 1) || ' (' || upper(p_type) || ')'
   when 3 then upper(substr(p_name, 1, 1)) || substr(split_part(p_name, ' ', 1), 2) else split_part(p_name, ' ', 1) end as title from part)"""


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, key = F.split_part("p_name", F.lit(" "), F.lit(1)), F.col("p_partkey")
    title = (
        F.when(key % 5 == 0, F.col("p_name"))
        .when(key % 5 == 1, F.upper(first))
        .when(key % 5 == 2, F.concat(first, F.lit(" ("), F.upper("p_type"), F.lit(")")))
        .when(key % 5 == 3, F.concat(F.upper(F.substring("p_name", 1, 1)), F.substr(first, F.lit(2))))
        .otherwise(first)
    )
    return table(spark, sf_dir, "part").select("p_partkey", first.alias("q"), F.upper("p_type").alias("country"), title.alias("title"))


_TITLED = "upper(substr(q, 1, 1)) || lower(substr(q, 2))"


@query(f"select p_partkey, (title in (q, upper(q), {_TITLED}) or title in (q || ' (' || country || ')', upper(q || ' (' || country || ')'))) as hit from {_CANDIDATES_SQL}")
def t5_exact_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select("p_partkey", text.exact_title(F.col("q"), F.col("country"), F.col("title")).alias("hit"))


@query(f"""
with names as (select p_brand, list(distinct title) as redirects from {_CANDIDATES_SQL} join part using (p_partkey) where p_partkey % 3 = 0 group by p_brand)
select p_partkey, list_has_any(redirects, [q, upper(q), {_TITLED}, q || ' (' || country || ')', upper(q || ' (' || country || ')')]) as redirect_hit,
  list_has_any(redirects, [q, upper(q), {_TITLED}]) or list_contains(list_transform(redirects, lambda r: upper(substr(r, 1, 1)) || lower(substr(r, 2))), q) as alternative_hit
from {_CANDIDATES_SQL} join part using (p_partkey) join names using (p_brand)""")
def t6_t7_name_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _candidates(spark, sf_dir).join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey")
    names = rows.where("p_partkey % 3 = 0").groupBy("p_brand").agg(F.collect_set("title").alias("redirects"))
    joined = rows.join(names, "p_brand")
    redirect = text.redirect_hit(F.col("q"), F.col("country"), F.col("redirects"))
    return joined.select("p_partkey", redirect.alias("redirect_hit"), text.alternative_hit(F.col("q"), F.col("redirects"), F.lit(None).cast("string")).alias("alternative_hit"))


_PAIRS = "with a as (select distinct p_name from part), p as (select x.p_name as a, y.p_name as b from a x join a y on x.p_name < y.p_name)"


def _name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    return names.select(F.col("p_name").alias("a")).join(names.select(F.col("p_name").alias("b")), F.col("a") < F.col("b"))


@query(f"{_PAIRS} select a, b, round(1 - levenshtein(a, b) / greatest(length(a), length(b)), 9) as similarity from p")
def t8_levenshtein(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _name_pairs(spark, sf_dir).select("a", "b", F.round(text.levenshtein_similarity(F.col("a"), F.col("b")), 9).alias("similarity"))


@query(r"""
with names as (select distinct unnest(list_filter(regexp_split_to_array(replace(strip_accents(lower(text)), 'ß', 'ss'), '[^\pL\pN]+'), lambda w: w <> '')) as name from benchmark),
p as (select x.name as a, y.name as b, levenshtein(x.name, y.name) as distance from names x join names y on x.name < y.name and abs(length(x.name) - length(y.name)) <= 2),
ends as (select unnest([a, b]) as name, distance from p where distance <= 2)
select name, count(distance) as links, min(distance)::int as nearest from names left join ends using (name) group by name""")
def t8_edit_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each different word of the benchmark, without accents (SQL counts bytes), with the number of words within two edits."""
    words = F.split(text.fold_accents(F.lower("text")), r"[^\p{L}\p{N}]+")
    names = table(spark, sf_dir, "benchmark").select(F.explode(words).alias("name")).where("name <> ''").distinct()
    return similar_names.link_counts(names, similar_names.edit_links(names, most=2))


@query(rf"""{_PAIRS.replace('with', 'with recursive')},
dp as (
  select a, b, 0 as i, list_transform(range(length(b) + 1), lambda x: 0) as cells from p
  union all
  select a, b, i + 1, list_reduce(range(1, length(b) + 1), lambda done, j: list_append(done, case when substr(b, j::int, 1) = substr(a, i + 1, 1) then cells[j] + 1 else greatest(cells[j + 1], done[len(done)]) end), [0]) from dp where i < length(a))
select a, b, round(cells[length(b) + 1] / greatest(length(a), length(b)), 9) as similarity from dp where i = length(a)""")
def t9_common_subsequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _name_pairs(spark, sf_dir).select("a", "b", F.round(text.subsequence_similarity(F.col("a"), F.col("b")), 9).alias("similarity"))


@query("""
select x.vec_id as a, y.vec_id as b, round(list_cosine_similarity(x.embedding::double[], y.embedding::double[]), 6) as cosine, round(list_inner_product(x.embedding::double[], y.embedding::double[]), 6) as dot
from embeddings x join embeddings y on y.vec_id = x.vec_id + 100""")
def t10_vector_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = table(spark, sf_dir, "embeddings")
    x, y = vecs.select(F.col("vec_id").alias("a"), F.col("embedding").alias("u")), vecs.select(F.col("vec_id").alias("b"), F.col("embedding").alias("v"))
    joined = x.join(y, F.col("b") == F.col("a") + 100)
    return joined.select("a", "b", F.round(vectors.cosine(F.col("u"), F.col("v")), 6).alias("cosine"), F.round(vectors.dot(F.col("u"), F.col("v")), 6).alias("dot"))


@query("select label, round(avg(x), 6) as mean, i as place from (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i from embeddings) group by label, i")
def p3_mean_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.collect_list("embedding").alias("vs"))
    return grouped.select("label", F.posexplode(vectors.mean_vector(F.col("vs"), 64)).alias("k", "m")).select("label", F.round("m", 6).alias("mean"), (F.col("k") + 1).cast("long").alias("place"))


@query(r"""
with items as (select item_id, trim(regexp_replace(text, '\s+', ' ', 'g')) as wanted from benchmark)
select doc_id, item_id, case when instr(d.text, wanted) > 0 then substr(d.text, greatest(instr(d.text, wanted) - 200, 1), instr(d.text, wanted) + length(wanted) + 200 - greatest(instr(d.text, wanted) - 200, 1)) else substr(d.text, 1, 400) end as shown
from documents d join items b on d.doc_id % (select count(*) from benchmark) = b.item_id""")
def p14_context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("query"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (F.col("doc_id") % items.count()).alias("item_id"))
    return docs.join(items, "item_id").select("doc_id", "item_id", text.context_window(F.col("text"), F.col("query")).alias("shown"))


@query("select p_partkey, replace(replace(replace('{country_1} meets {country_2} in {city}', '{country_1}', p_brand), '{country_2}', p_type), '{city}', p_name) as headline from part")
def t30_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = text.fill_template(F.lit("{country_1} meets {country_2} in {city}"), {"country_1": F.col("p_brand"), "country_2": F.col("p_type"), "city": F.col("p_name")})
    return table(spark, sf_dir, "part").select("p_partkey", filled.alias("headline"))


@query("select p_partkey, list_sort(list_distinct(list_concat([p_name, strip_accents('é' || p_name)], [strip_accents(p_name), 'é' || p_name]))) as names, list_sort(list_distinct([p_type, p_name])) as entries from part")
def f8_f9_clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.array(F.concat(F.lit("[["), F.col("p_name"), F.lit("]]")), F.concat(F.lit("é"), F.col("p_name")), F.lit("son:"))
    entries = F.array(F.col("p_name"), F.concat(F.col("p_type"), F.lit(" (disambiguation)")), F.concat(F.col("p_name"), F.lit("/x")), F.lit("a#b"))
    return table(spark, sf_dir, "part").select("p_partkey", text.clean_names(raw).alias("names"), text.clean_entries(entries).alias("entries"))


_DATES_SQL = """(select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as published, o_orderdate::date as d, case o_orderkey % 10
 when 0 then null when 1 then strftime(o_orderdate - interval 3 day, '%B ') || day(o_orderdate - interval 3 day) || strftime(o_orderdate - interval 3 day, ', %Y')
 when 2 then 'yesterday' when 3 then '3 days ago' when 4 then 'two weeks ago' when 5 then 'last Monday' when 6 then 'next Friday' when 7 then 'on Sunday'
 when 8 then 'some day' else 'May 5' end as raw from orders)"""


@query(f"""
select o_orderkey, strftime(case o_orderkey % 10 when 0 then d when 1 then d - 3 when 2 then d - 1 when 3 then d - 3 when 4 then d - 14
  when 5 then d - (case when (isodow(d)::int - 1) % 7 = 0 then 7 else (isodow(d)::int - 1 + 7) % 7 end)
  when 6 then d + (case when (5 - isodow(d)::int + 7) % 7 = 0 then 7 else (5 - isodow(d)::int + 7) % 7 end)
  when 7 then d - (case when isodow(d)::int = 7 then 7 else isodow(d)::int end) when 8 then d
  else make_date(year(d) - (case when make_date(year(d), 5, 5) > d then 1 else 0 end), 5, 5) end, '%Y-%m-%d') as date_resolved,
 case o_orderkey % 10 when 0 then '<No date detected--using publication date>' when 6 then 'Friday' when 8 then '<dateparser failed to convert relative date--using pub date>' else raw end as date_raw
from {_DATES_SQL}""")
def t24_resolve_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 10
    fixed = {2: "yesterday", 3: "3 days ago", 4: "two weeks ago", 5: "last Monday", 6: "next Friday", 7: "on Sunday", 8: "some day", 9: "May 5"}
    raw = F.when(k == 1, F.date_format(F.date_sub(d, 3), "MMMM d, yyyy"))
    for n, phrase in fixed.items():
        raw = raw.when(k == n, phrase)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"), F.date_format(d, "yyyy-MM-dd").alias("published"))
    return dates.resolve_dates(rows, "raw", "published").select("o_orderkey", "date_resolved", "date_raw")


#: Phrases, and in SQL the date that each means from a day d; those after the first null mean none.
_PHRASES = [
    ("today", "d"), ("the day before yesterday", "d - 2"), ("tomorrow", "d + 1"), ("five days earlier", "d - 5"), ("2 weeks and 3 days ago", "d - 17"), ("a month ago", "(d - interval 1 month)::date"), ("1 year, 2 months ago", "(d - interval 14 month)::date"),
    ("5 hours ago", "d - 1"), ("49 hours ago", "d - 3"), ("in 3 days", "d + 3"), ("two days from now", "d + 2"), ("10 days", "d - 10"), ("last week", "d - 7"), ("this year", "d"), ("next month", "(d + interval 1 month)::date"), ("Thursday", "d - ((isodow(d)::int - 4 + 6) % 7 + 1)"), ("last Sat.", "d - ((isodow(d)::int - 6 + 6) % 7 + 1)"),
    ("May 2019", "make_date(2019, 5, day(d))"), ("in 2018", "make_date(2018, month(d), case when month(d) = 2 then least(day(d), 28) else day(d) end)"), ("July", "make_date(year(d) - (case when make_date(year(d), 7, day(d)) > d then 1 else 0 end), 7, day(d))"),
    ("5 May", "make_date(year(d) - (case when make_date(year(d), 5, 5) > d then 1 else 0 end), 5, 5)"), ("the 3rd of March", "make_date(year(d) - (case when make_date(year(d), 3, 3) > d then 1 else 0 end), 3, 3)"), ("Monday, December 4", "make_date(year(d) - (case when make_date(year(d), 12, 4) > d then 1 else 0 end), 12, 4)"),
    ("May 4 2020", "date '2020-05-04'"), ("Mon, 4 May 2020", "date '2020-05-04'"), ("2020-05-04T10:00:00", "date '2020-05-04'"), ("5/4/2020", "date '2020-05-04'"), ("20200504", "date '2020-05-04'"), ("Sept. 9, 2019 at 3:15 pm", "date '2019-09-09'"), ("the 1st", "date_trunc('month', d)::date"),
    ("February 30, 2020", None), ("some day", None), ("May June", None), ("soon after the vote", None),
]


@query(f"""
with t as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as published, o_orderdate::date as d, o_orderkey % {len(_PHRASES)} as k, list_extract([{", ".join(f"'{p}'" for p, _ in _PHRASES)}], (o_orderkey % {len(_PHRASES)} + 1)::int) as raw from orders),
r as (select *, case k {" ".join(f"when {k} then {e}" for k, (_, e) in enumerate(_PHRASES) if e)} end as told from t)
select o_orderkey, coalesce(strftime(told, '%Y-%m-%d'), published) as date_resolved, case when told is null then '<dateparser failed to convert relative date--using pub date>' else raw end as date_raw from r""")
def t24_date_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of every kind, read from the dates of all orders."""
    raw = F.get(F.array(*[F.lit(p) for p, _ in _PHRASES]), (F.col("o_orderkey") % len(_PHRASES)).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("published"))
    return dates.resolve_dates(rows, "raw", "published").select("o_orderkey", "date_resolved", "date_raw")
