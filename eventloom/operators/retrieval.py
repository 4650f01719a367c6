"""Scored full-text retrieval on inverted-index tables: BM25 and token-overlap fields, exact words, required terms, importance."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.operators.knowledge import holds_any
from eventloom.operators.spread import shuffled, spread_join, tasks


@dataclass(frozen=True)
class Field:
    """A searched field.

    boost weighs a match of the query's words, exact one of the query as it stands with a single word of the field. A
    boolean field counts matches alike, others by BM25. An array's items are searched together; in a whole field each
    item, or the text itself, is one word, as it stands.
    """

    name: str
    boost: float
    exact: float = 0.0
    boolean: bool = False
    array: bool = False
    whole: bool = False


#: Fixed domain values: the boosts of the default query.
DEFAULT_FIELDS = [
    Field("title", 50, exact=250),
    Field("redirects", 50, exact=100, boolean=True, array=True),
    Field("alternative_names", 20, exact=100, array=True),
    Field("intro_para", 5),
    Field("short_desc", 10),
]
#: Fixed domain values: the boosts of a term that an article must hold besides.
REQUIRED_FIELDS = [
    Field("title", 100),
    Field("redirects", 100, boolean=True, array=True),
    Field("alternative_names", 1, array=True),
    Field("intro_para", 1),
    Field("categories", 1, array=True, whole=True),
    Field("infobox", 1, array=True, whole=True),
]
#: Fixed domain values: what an article gains by the number of its redirects, categories and alternative names.
IMPORTANCE = [("redirects", 5, 5), ("redirects", 10, 30), ("redirects", 20, 100), ("categories", 5, 3), ("categories", 10, 50), ("alternative_names", 2, 2), ("alternative_names", 5, 10)]
#: Fixed domain values: what an article gains by having an infobox and a short description.
PRESENCE = [("infobox", 3), ("short_desc", 2)]
K1, B = 1.2, 0.75


def tokens(text: Column) -> Column:
    """Words in lower case: runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


#: Postings of a word fall into levels of impact, so many to one; a level is skipped as a whole where it can't matter.
LEVELS = 16
#: A first guess of a search's k-th score comes from the scores of about SEEDS * k articles a query, taken from a level by
#: parts of about PART postings. With more than MOST_SEEDS in all, or MOST_TERMS rows of levels, they aren't sent around,
#: and the search goes without bounds.
SEEDS, PART, MOST_SEEDS, MOST_TERMS = 3, 128, 1_000_000, 1_000_000
#: Bounds are held to be reached so much earlier, as sums are rounded.
ROUNDING = 1e-9
#: A task scores articles in blocks of about so many postings, and of about so many products of a query's weight and a posting's impact.
ROWS, PRODUCTS = 100_000, 2_000_000
#: A task counts about so many words of articles when an index is built.
WORDS = 300_000
#: Ranks go by scores rounded to nine places, so what is this much below a k-th best score can't be among the k best.
MARGIN = 1e-8


@dataclass(frozen=True)
class Index:
    """postings(field, token, level, article_id, impact), frequencies(field, token, idf), levels(field, token, level, n, most).

    impact is what a posting brings in a field of boost 1 for an idf of 1: the part of BM25 that depends on the article
    alone. So a search reads one table and adds up products; lengths and means aren't looked up again. In boolean fields
    both numbers are 1. A level holds n postings of a word whose impacts are alike, the highest being most.
    """

    postings: DataFrame
    frequencies: DataFrame
    levels: DataFrame
    totals: DataFrame | None = None  # (field, n, mean_len) of an index that isn't written yet


def build_index(articles: DataFrame, fields: list[Field]) -> Index:
    """The tables of an inverted index over articles(article_id, fields). write_index() them to search more than once.

    Articles are read once for the numbers and mean lengths of fields, and once for postings.
    """

    def words(f: Field) -> Column:
        items = F.col(f.name) if f.array else F.array(f.name)
        if f.whole:
            return F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")
        return tokens(F.coalesce(F.array_join(items, " "), F.lit("")))

    unique = list({f.name: f for f in fields}.values())
    flat = lambda which: F.col("field").isin(*[f.name for f in unique if which(f)] or [""])
    per_field = F.array(*[F.struct(F.lit(f.name).alias("field"), words(f).alias("tokens")) for f in unique])
    split = lambda rows: rows.select("article_id", F.explode(per_field).alias("f")).select("article_id", "f.field", "f.tokens").where(F.size("tokens") > 0)
    totals = split(articles).groupBy("field").agg(F.count("*").alias("n"), F.avg(F.size("tokens")).alias("mean_len"))
    known = totals.collect()  # a row per field, for postings and for frequencies
    totals = articles.sparkSession.createDataFrame(known, totals.schema)
    # Texts are shuffled, and not their words: all words of an article are counted where it is, in tasks of about WORDS words.
    dealt = split(articles.repartition(tasks(articles.sparkSession, sum(r.n * r.mean_len for r in known), WORDS), "article_id"))
    counted = dealt.select("article_id", "field", F.size("tokens").alias("len"), F.explode("tokens").alias("token")).groupBy("field", "token", "article_id").agg(F.count("*").alias("tf"), F.first("len").alias("len"))
    boolean, whole = flat(lambda f: f.boolean), flat(lambda f: f.whole)
    norm = F.when(whole, 1.0).otherwise(1 - B + B * F.col("len") / F.col("mean_len"))
    impact = F.when(boolean, 1.0).otherwise(F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * norm))
    postings = counted.join(F.broadcast(totals), "field").select("field", "token", F.floor(impact * LEVELS).cast("int").alias("level"), "article_id", impact.alias("impact"))
    totals = totals.withColumn("boolean", boolean)
    levels = _levels(postings)
    return Index(postings, _frequencies(levels, totals), levels, totals)


def _levels(postings: DataFrame) -> DataFrame:
    return postings.groupBy("field", "token", "level").agg(F.count("*").alias("n"), F.max("impact").alias("most"))


def _frequencies(levels: DataFrame, totals: DataFrame) -> DataFrame:
    df = F.col("df")
    idf = F.when(F.col("boolean"), 1.0).otherwise(F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5)))
    return levels.groupBy("field", "token").agg(F.sum("n").alias("df")).join(F.broadcast(totals), "field").select("field", "token", idf.alias("idf"))


def write_index(index: Index, path: str) -> None:
    """Writes an index that was built. Postings stay where they were counted, dealt by article, so that they aren't
    shuffled and a word in every article is no task of its own. Each file is sorted by token and level, so that a
    search for few words skips most row groups of it. The other tables are made of the written postings.
    """
    spark = index.postings.sparkSession
    index.postings.sortWithinPartitions("token", "level").write.mode("overwrite").parquet(f"{path}/postings")
    _levels(spark.read.parquet(f"{path}/postings")).write.mode("overwrite").parquet(f"{path}/levels")
    _frequencies(spark.read.parquet(f"{path}/levels"), index.totals).write.mode("overwrite").parquet(f"{path}/frequencies")


def read_index(spark: SparkSession, path: str) -> Index:
    """A written index; one without the expected columns is refused."""
    index = Index(*[spark.read.parquet(f"{path}/{part}") for part in ("postings", "frequencies", "levels")])
    expected = [(index.postings, {"field", "token", "level", "article_id", "impact"}), (index.frequencies, {"field", "token", "idf"}), (index.levels, {"field", "token", "level", "n", "most"})]
    missing = {c for df, columns in expected for c in columns - set(df.columns)}
    if missing:
        raise ValueError(f"no usable index at {path}: {', '.join(sorted(missing))} missing")
    return index


def _clauses(queries: DataFrame, text: str, fields: list[Field], required: bool) -> DataFrame:
    """(query_id, required, field, token, boost): a row for each word of a query and field, and for the query as it stands."""
    whole = lambda boost, f: F.when(F.col(text) != "", F.array(F.struct(F.lit(f.name).alias("field"), F.col(text).alias("token"), F.lit(float(boost)).alias("boost"))))
    analysed = lambda f: F.transform(F.array_distinct(tokens(F.col(text))), lambda t: F.struct(F.lit(f.name).alias("field"), t.alias("token"), F.lit(float(f.boost)).alias("boost")))
    parts = [whole(f.boost, f) if f.whole else analysed(f) for f in fields] + [whole(f.exact, f) for f in fields if f.exact]
    none = F.expr("cast(array() as array<struct<field:string,token:string,boost:double>>)")
    return queries.select("query_id", F.lit(required).alias("required"), F.explode(F.concat(*[F.coalesce(p, none) for p in parts])).alias("c")).select("query_id", "required", "c.*")


def search(queries: DataFrame, index: Index, fields: list[Field], k: int = 200, required: DataFrame | None = None, required_fields: list[Field] = REQUIRED_FIELDS, importance: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] | None = None, few: int | None = None) -> DataFrame:
    """(query_id, article_id, score, rank): the k best articles for each of queries(query_id, query).

    The score is the sum, over fields and the query's words, of boost times BM25, or of the boost alone in boolean fields,
    and of the exact boost where the query itself is a word of the field. With required(query_id, term) an article must
    match the term too, in required_fields, and its score there is added. importance(article_id, bonus) adds a bonus to
    articles that match. Postings meet clauses by word; a word in very many articles is dealt to several tasks, and isn't
    shuffled where no query holds it (spread_join). Products are summed per partition before they shuffle by query and article, and the rank filter is pushed
    into the window, so each partition sorts k rows a query. Scores that are equal to nine places rank by article_id.

    With keep, a function that writes a small table and reads it back, and up to MOST_TERMS words of queries, postings of
    these words are shuffled by article, once for all queries, and each task keeps the k best of its own (_by_article).
    With few besides, a search without a required term leaves out what can't reach the k best (_bounded), if its words
    have more than few postings. The result is the same.
    """
    clauses = _clauses(queries, "query", fields, False)
    if required is not None:
        clauses = clauses.unionByName(_clauses(required, "term", required_fields, True))
    frequencies = shuffled(index.frequencies) if keep is None else index.frequencies  # without keep, queries may be as many as articles
    terms = clauses.join(frequencies, ["field", "token"]).select("query_id", "required", "field", "token", (F.col("boost") * F.col("idf")).alias("weight"))
    scored = None
    if required is None and keep is not None and few is not None:
        ends = importance.agg(F.least(F.min("bonus"), F.lit(0.0)), F.greatest(F.max("bonus"), F.lit(0.0))).first() if importance is not None else (0.0, 0.0)
        scored = _bounded(terms.drop("required"), index, k, (ends[1] or 0.0) - (ends[0] or 0.0), keep, few)
    if scored is None and keep is not None:
        terms = keep(terms)
        if terms.count() <= MOST_TERMS:
            scored = _by_article(terms, index.postings, ["field", "token"], keep, k, importance, required is not None)
            importance = None
    if scored is None:
        word = ["field", "token"]
        hits = spread_join(index.postings, terms, word, F.col("article_id"), index.levels.groupBy(*word).agg(F.sum("n").alias("n")))
        scored = hits.groupBy("query_id", "article_id").agg(F.sum(F.col("weight") * F.col("impact")).alias("score"), F.max("required").alias("held"), F.min("required").alias("only"))
        scored = scored.where("not only" if required is None else "held and not only").select("query_id", "article_id", "score")
    if importance is not None:
        scored = scored.join(importance, "article_id", "left").select("query_id", "article_id", (F.col("score") + F.coalesce("bonus", F.lit(0.0))).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "article_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _by_article(terms: DataFrame, postings: DataFrame, on: list[str], keep: Callable[[DataFrame], DataFrame], k: int | None = None, importance: DataFrame | None = None, held: bool = False, floors: DataFrame | None = None) -> DataFrame:
    """(query_id, article_id, score) by terms(query_id, weight, required, on): the scores of all articles that match, or with
    k at least those that can be among a query's k best.

    A posting of any query's word goes once to its article's task, whatever the number of queries that hold the word.
    There, scores of a block of articles are summed for all queries at once, and all but each query's best are dropped
    before anything is shuffled by query. Each task gets all terms, which the caller knows to be few. With held, articles
    must match a required term as well as another; with floors(query_id, floor) scores below a query's floor are dropped.
    """
    words = keep(terms.groupBy(*on).agg(F.collect_list(F.struct("query_id", "weight", "required")).alias("uses")).withColumn("term", F.monotonically_increasing_id()))
    uses = words.select("term", F.explode("uses").alias("u")).select("term", "u.*").toArrow().sort_by("term")
    ids, query = np.unique(uses["term"].to_numpy()), uses["query_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    floor = np.full(len(query.dictionary), -np.inf)
    if floors is not None:
        known = {r.query_id: r.floor for r in floors.collect()}
        floor = np.array([known.get(q, -np.inf) for q in query.dictionary.to_pylist()], dtype="float64")
    shared = postings.sparkSession.sparkContext.broadcast({
        "ids": ids, "starts": np.searchsorted(uses["term"].to_numpy(), ids), "ends": np.searchsorted(uses["term"].to_numpy(), ids, "right"),
        "query": query.indices.to_numpy(), "queries": query.dictionary, "weight": uses["weight"].to_numpy(), "required": uses["required"].to_numpy(), "floor": floor,
    })
    met = postings.join(F.broadcast(words.select(*on, "term")), on).select("article_id", "term", "impact").repartition("article_id")
    met = met.join(importance, "article_id", "left") if importance is not None else met.withColumn("bonus", F.lit(0.0))
    met = met.select("article_id", "term", "impact", F.coalesce("bonus", F.lit(0.0)).cast("double").alias("bonus")).sortWithinPartitions("article_id", "term")
    kinds = {f.name: f.dataType.simpleString() for f in terms.schema.fields + postings.schema.fields}
    return met.mapInArrow(lambda batches: _blocks(batches, shared.value, k, held), f"query_id {kinds['query_id']}, article_id {kinds['article_id']}, score double")


def _blocks(batches: Iterator[pa.RecordBatch], shared: dict, k: int | None, held: bool) -> Iterator[pa.RecordBatch]:
    """Scores rows (article_id, term, impact, bonus), which are sorted by article, in blocks of whole articles."""
    floor, size = shared["floor"].copy(), shared["ends"] - shared["starts"]
    pending, n_rows = [], 0
    for batch in batches:
        pending.append(pa.Table.from_batches([batch]))
        n_rows += batch.num_rows
        if n_rows >= ROWS:
            rows = pa.concat_tables(pending).combine_chunks()
            firsts, products = _articles(rows, shared, size)
            cut = done = 0
            for first in firsts[1:]:  # the last article may go on in the next batch
                if first == firsts[-1] or products[first - 1] - done >= PRODUCTS:
                    yield from _best(rows.slice(cut, first - cut), shared, size, k, held, floor)
                    cut, done = first, products[first - 1]
            pending, n_rows = [rows.slice(cut)], 0
    if sum(p.num_rows for p in pending):
        yield from _best(pa.concat_tables(pending).combine_chunks(), shared, size, k, held, floor)


def _articles(rows: pa.Table, shared: dict, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where articles begin, and how many products there are up to each row."""
    code = rows["article_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.flatnonzero(np.diff(code, prepend=-1)), np.cumsum(size[np.searchsorted(shared["ids"], rows["term"].to_numpy())])


def _best(rows: pa.Table, shared: dict, size: np.ndarray, k: int | None, held: bool, floor: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The scores of a block of articles. floor, by query, is what a score must reach; it rises with what was found, if there is a k."""
    firsts, _ = _articles(rows, shared, size)
    article = np.cumsum(np.bincount(firsts, minlength=rows.num_rows)) - 1
    term = np.searchsorted(shared["ids"], rows["term"].to_numpy())
    n = size[term]
    posting = np.repeat(np.arange(len(n)), n)
    use = np.arange(len(posting)) + np.repeat(shared["starts"][term] - (np.cumsum(n) - n), n)
    key = shared["query"][use].astype("int64") * len(firsts) + article[posting]
    keys = len(floor) * len(firsts)
    cells = None
    if keys > 4 * len(key):  # few of many queries match
        cells, key = np.unique(key, return_inverse=True)
        keys = len(cells)
    required = shared["required"][use]
    score = np.bincount(key, shared["weight"][use] * rows["impact"].to_numpy()[posting], keys)
    kept = np.bincount(key[~required], minlength=keys) > 0
    if held:
        kept &= np.bincount(key[required], minlength=keys) > 0
    at = np.flatnonzero(kept)
    score, (query, which) = score[at], np.divmod(at if cells is None else cells[at], len(firsts))
    score = score + rows["bonus"].to_numpy()[firsts[which]]
    reach = score >= floor[query]
    score, query, which = score[reach], query[reach], which[reach]
    if k is not None:
        order = np.lexsort((which, -score, query))
        score, query, which = score[order], query[order], which[order]
        begin = lambda new: np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        of_query = np.diff(query, prepend=-1) != 0
        kth = np.flatnonzero(np.arange(len(query)) - begin(of_query) == k - 1)
        floor[query[kth]] = np.maximum(floor[query[kth]], score[kth] - MARGIN)
        equal = begin(of_query | (np.diff(score, prepend=np.nan) != 0))
        good = (score >= floor[query]) & (np.arange(len(query)) - equal < k)  # of equal scores the k first articles
        score, query, which = score[good], query[good], which[good]
    if len(score):
        ids = rows["article_id"].combine_chunks().take(pa.array(firsts[which]))
        yield pa.RecordBatch.from_arrays([shared["queries"].take(pa.array(query)), ids, pa.array(score)], ["query_id", "article_id", "score"])


def _products(terms: DataFrame, postings: DataFrame, *on: str) -> DataFrame:
    """What each posting of terms(query_id, field, token, weight) brings to a query. terms are known to be few."""
    return postings.join(F.broadcast(terms), list(on)).select("query_id", "article_id", (F.col("weight") * F.col("impact")).alias("score"))


def _added(products: DataFrame) -> DataFrame:
    return products.groupBy("query_id", "article_id").agg(F.sum("score").alias("score"))


def _bounded(terms: DataFrame, index: Index, k: int, slack: float, keep: Callable[[DataFrame], DataFrame], few: int) -> DataFrame | None:
    """(query_id, article_id, score) of all articles that can be among the k best of a query by terms(query_id, field,
    token, weight), to whose scores up to slack is added later; None if terms or seeds are too many, or postings few.

    1. Some articles with high impacts (seeds) are scored in full. The k-th best of their scores is at most that of all.
       A word all of whose articles are among them is done with: no other article holds it.
    2. A word's bound is its weight times its highest impact. A level of a word is left out if an article in it stays
       below that score with all other words at their bounds.
    3. The levels that stay are added up by article (_by_article); what doesn't reach that score is dropped there.
    """
    spans = keep(_merged(terms).join(index.levels, ["field", "token"]))
    sizes = spans.agg(F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("postings")).first()
    if sizes.rows > MOST_TERMS or sizes.postings <= few:
        return None
    bound = F.col("weight") * F.col("most")
    falling = Window.partitionBy("query_id").orderBy(F.desc(bound), "field", "token", "level")
    before = F.coalesce(F.sum("n").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = spans.withColumn("open", SEEDS * k - before).where("open > 0")
    parts, taken = F.ceil(F.col("n") / PART), F.ceil(F.col("open") / PART)
    drawn = F.pmod(F.xxhash64("article_id"), parts) < taken
    seeds = keep(index.postings.join(F.broadcast(first), ["field", "token", "level"]).where(drawn).select("query_id", "article_id").distinct())
    if seeds.count() > MOST_SEEDS:
        return None
    words = spans.groupBy("query_id", "field", "token").agg(F.first("weight").alias("weight"), F.max(bound).alias("bound"))
    taken_whole = first.where(taken >= parts).groupBy("query_id", "field", "token").agg(F.count("*").alias("of_seeds"))
    exhausted = spans.groupBy("query_id", "field", "token").agg(F.count("*").alias("of_word")).join(taken_whole, ["query_id", "field", "token"]).where("of_seeds = of_word")
    full = _added(_products(words.drop("bound"), index.postings, "field", "token").join(F.broadcast(seeds), ["query_id", "article_id"], "left_semi"))
    full = keep(full)
    kth = full.withColumn("_k", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "article_id"))).where(F.col("_k") == k)
    least = kth.select("query_id", (F.col("score") * (1 - ROUNDING) - slack).alias("least"))
    summed = words.join(exhausted, ["query_id", "field", "token"], "left_anti").withColumn("all", F.sum("bound").over(Window.partitionBy("query_id"))).join(least, "query_id", "left")
    reaches = F.col("least").isNull() | (F.col("all") - F.col("bound") + F.col("weight") * F.col("most") >= F.col("least"))
    used = keep(summed.join(spans.drop("weight"), ["query_id", "field", "token"]).where(reaches).select("query_id", "field", "token", "level", "weight", F.lit(False).alias("required")))
    floors = least.withColumnRenamed("least", "floor").where("floor is not null")
    found = _by_article(used, index.postings, ["field", "token", "level"], keep, None if slack else k, floors=floors)
    return full.unionByName(found).groupBy("query_id", "article_id").agg(F.max("score").alias("score"))


def _merged(terms: DataFrame) -> DataFrame:
    """A word that a query holds twice in a field, as a word and as the whole query, once."""
    return terms.groupBy("query_id", "field", "token").agg(F.sum("weight").alias("weight"))


def importance_bonus(redirects: Column, categories: Column, alternative_names: Column, infobox: Column, short_desc: Column) -> Column:
    """What an article gains by its importance: by the sizes of its lists, and for having an infobox or a short description."""
    sizes = {"redirects": F.coalesce(F.size(redirects), F.lit(0)), "categories": F.coalesce(F.size(categories), F.lit(0)), "alternative_names": F.coalesce(F.size(alternative_names), F.lit(0))}
    has = {"infobox": F.coalesce(F.size(infobox), F.lit(0)) > 0, "short_desc": F.coalesce(short_desc, F.lit("")) != ""}
    gains = [F.when(sizes[f] >= least, float(boost)).otherwise(0.0) for f, least, boost in IMPORTANCE] + [F.when(has[f], float(boost)).otherwise(0.0) for f, boost in PRESENCE]
    return reduce(lambda a, b: a + b, gains)


def recall_at(hits: DataFrame, gold: DataFrame, cutoffs: list[int]) -> DataFrame:
    """(k, recall): the share of gold(query_id, article_id) found among the first k hits; a null gold article counts as found."""
    ranked = gold.join(hits.select("query_id", "article_id", "rank"), ["query_id", "article_id"], "left")
    at = ranked.select("article_id", "rank", F.explode(F.array(*map(F.lit, cutoffs))).alias("k"))
    return at.groupBy("k").agg(F.avg((F.col("article_id").isNull() | F.coalesce(F.col("rank") <= F.col("k"), F.lit(False))).cast("int")).alias("recall"))


#: Fixed domain values: what the title of no actor's article holds, in the order of the checks, and where.
UNWANTED_TITLES = [
    ("anywhere", "stub:"),
    ("anywhere", "User:"),
    ("anywhere", "Wikipedia:"),
    ("start", "Wikipedia:"),
    ("start", "Talk:"),
    ("anywhere", "disambiguation"),
    ("start", "Template:"),
    ("start", "Category:"),
    ("start", "Portal:"),
]
#: Fixed domain values: what the introduction of no actor's article holds, in the order of the checks, and among how many
#: first characters.
UNWANTED_INTROS = [
    (50, "Category:"),
    (50, "is the name of"),
    (50, "may refer to"),
    (40, "is used as an abbreviation for"),
    (50, "can refer to"),
    (50, "most commonly refers to"),
    (80, "usually refers to"),
    (80, "may stand for"),
    (50, "is a surname"),
]


def good_article(title: Column, intro: Column) -> Column:
    """Whether a retrieved article can be an actor: no maintenance page, no list of meanings, and an introduction of some length."""
    bad = holds_any(title, UNWANTED_TITLES) | holds_any(intro, UNWANTED_INTROS)
    return F.coalesce(~bad & (F.length(intro) > 50) & (F.trim(intro) != ""), F.lit(False))
