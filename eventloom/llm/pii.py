"""Personal data: exact base patterns, and identifiers that bootstrapped contexts find beside them. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import cut

KINDS = ["email", "ip", "card", "phone"]
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: A run can begin a match only at its first character or where the last match ended, so no other start is tried. All
#: repeated groups are possessive, which the regex engine walks in a loop: time is linear in the text and the stack flat.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: What may be an identifier though no base pattern takes it: an address without a dot or with "at" and "dot" written out,
#: colon-parted hexadecimal or defanged network addresses, and 9 to 19 digits with any marks between, spaces included,
#: where no number stands before.
_ADDRESS = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++(?:@|\x20?[\[({]at[\])}]\x20?|\x20at\x20(?=[\p{L}\p{N}-]++\x20dot\x20))[\p{L}\p{N}-]++(?:(?:\.|\x20?[\[({]dot[\])}]\x20?|\x20dot\x20)[\p{L}\p{N}-]++)*+"
_HOST = r"(?<![\p{L}\p{N}:.])(?:(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{1,4}(?![\p{L}\p{N}:])|[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?![0-9]))"
_NUMBER = r"(?<![0-9])(?<![0-9][\x20().\/_-]{1,3})[+(]{0,2}[0-9](?:[\x20().\/_-]{0,3}[0-9]){8,18}(?![0-9])"
#: The last and the first words beside a span, REACH at most and of any length; a match begins at a word, so long runs of marks cost one step each.
REACH = 5
_WORDS_BEFORE = rf"(?:^|(?<=[^\p{{L}}\p{{N}}])(?=[\p{{L}}\p{{N}}]))((?:[\p{{L}}\p{{N}}]++[^\p{{L}}\p{{N}}]++){{0,{REACH - 1}}}[\p{{L}}\p{{N}}]*+)[^\p{{L}}\p{{N}}]*+$"
_WORDS_AFTER = rf"^[^\p{{L}}\p{{N}}]*+([\p{{L}}\p{{N}}]++(?:[^\p{{L}}\p{{N}}]++[\p{{L}}\p{{N}}]++){{0,{REACH - 1}}})"


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """The array's running sums under an associative join, in log2(n) passes over it: appending one by one would copy all before it."""

    def doubled(done: Column, k: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(done, lambda x, i: F.when(i >= step, join(F.get(done, i - step), x)).otherwise(x))

    def passes(v: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(v), F.lit(2)).cast("double"))).cast("int") - 1), v, doubled)

    return bound(values, passes)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once: a lambda that names an expression computes it for each element anew."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _found(text: Column, pattern: str) -> Column:
    """The matches of pattern in text: array of (start, end, hit, left, right), places in code points, left and right up to REACH words beside it, in lower case with a space between."""
    words = lambda gap, where: F.trim(F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(gap, F.lit("")), where, 1)), r"[^\p{L}\p{N}]+", " "))

    def steps(p: Column) -> Column:
        return F.transform(p["hits"], lambda h, i: F.struct(F.get(p["gaps"], i).alias("gap"), h.alias("hit"), F.get(p["gaps"], i + 1).alias("next")))

    def shape(s: Column, end: Column) -> Column:
        return F.struct((end - F.length(s["hit"])).alias("start"), end.alias("end"), s["hit"].alias("hit"), words(s["gap"], _WORDS_BEFORE).alias("left"), words(s["next"], _WORDS_AFTER).alias("right"))

    def placed(parts: Column) -> Column:
        return F.zip_with(parts, running(F.transform(parts, lambda s: F.length(s["gap"]) + F.length(s["hit"])), lambda a, b: a + b), shape)

    cut_up = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return bound(bound(cut_up, steps), placed)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right: every second digit from the right counts twice, digits of that summed."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


_NONE = "cast(array() as array<struct<start:int,end:int,hit:string,left:string,right:string>>)"
_SPAN = "array<struct<start:int,kind:int,end:int,hit:string,left:string,right:string>>"


def seed_spans(text: Column) -> Column:
    """All base matches of a text, with the words beside them: array of (start, kind, end, hit, left, right), kind being a place in KINDS; by start, then kind."""
    none = F.expr(_NONE)
    size = lambda x: F.length(_digits(x["hit"]))
    found = [
        F.when(F.contains(text, F.lit("@")), _found(text, _EMAIL)).otherwise(none),
        F.filter(F.when(text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), _found(text, _IP)).otherwise(none), lambda x: x["hit"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")),
        F.filter(F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), _found(text, _CARD)).otherwise(none), lambda x: size(x).between(12, 19) & _luhn(_digits(x["hit"]))),
        F.filter(F.when(F.contains(text, F.lit("+")), _found(text, _PHONE)).otherwise(none), lambda x: size(x).between(9, 15)),
    ]
    return F.array_sort(F.concat(*[F.transform(f, _tagged(k)) for k, f in enumerate(found)]))


def _tagged(kind: int) -> Callable[[Column], Column]:
    return lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["hit"].alias("hit"), x["left"].alias("left"), x["right"].alias("right"))


def candidates(text: Column, base: Column) -> Column:
    """What looks like an identifier and touches no base span: the same array as base; kind is email, ip, or for a number card.

    A number of 9 to 15 digits may be a phone, one of 12 to 19 a card; which of the two is for its contexts to tell. Which
    candidates touch a base span is told by one merge: in the order of places, a candidate sees the furthest end of the
    base spans that begin before its own end.
    """
    none = F.expr(_NONE)
    found = [
        F.when(text.rlike(r"@|[\[({]at[\])}]|\x20dot\x20"), _found(text, _ADDRESS)).otherwise(none),
        F.when(text.rlike(r":[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}:|[0-9][\[(](?:\.|dot)[\])]"), _found(text, _HOST)).otherwise(none),
        F.when(text.rlike(r"[0-9](?:[\x20().\/_-]{0,3}[0-9]){8}"), _found(text, _NUMBER)).otherwise(none),
    ]
    made = F.concat(*[F.transform(f, _tagged(k)) for k, f in enumerate(found)])
    event = lambda x, at, order, end: F.struct(at.alias("at"), F.lit(order).alias("order"), end.alias("reach"), x.alias("span"))

    def apart(m: Column) -> Column:
        seen = F.zip_with(m, running(F.transform(m, lambda e: e["reach"]), F.greatest), lambda e, r: F.struct(e["order"].alias("order"), r.alias("reach"), e["span"].alias("span")))
        return F.transform(F.filter(seen, lambda e: (e["order"] == 0) & (e["reach"] <= e["span"]["start"])), lambda e: e["span"])

    def merged(new: Column) -> Column:
        events = F.array_sort(F.concat(F.transform(new, lambda x: event(x, x["end"], 0, F.lit(-1))), F.transform(base, lambda x: event(x, x["start"], 1, x["end"]))))
        return F.when(F.size(new) == 0, F.expr(f"cast(array() as {_SPAN})")).otherwise(bound(events, apart))

    return bound(made, merged)


def lexical_patterns(context: Column, side: str) -> Column:
    """The patterns of a context of up to REACH words, as an array of (pattern, root, wide); none of an empty context.

    The narrow pattern is the word nearest to the span; it is also the root of the wide ones: each other word of the context
    before (after) the nearest, whatever stands between, and the three nearest words in a row.
    """
    words = F.split(context, " ")
    outwards = F.reverse(words) if side == "left" else words
    text = lambda ws, gap: F.concat(F.lit(f"{side} "), F.array_join(F.reverse(ws) if side == "left" else ws, gap))

    def made(w: Column) -> Column:
        near = F.get(w, F.lit(0))
        root = text(F.array(near), " ")
        pattern = lambda p, wide: F.struct(p.alias("pattern"), root.alias("root"), F.lit(wide).alias("wide"))
        gapped = F.transform(F.array_distinct(F.slice(w, 2, REACH)), lambda x: pattern(text(F.array(near, x), " ... "), True))
        row = F.filter(F.array(pattern(text(F.slice(w, 1, 3), " "), True)), lambda _: F.size(w) >= 3)
        return F.concat(F.array(pattern(root, False)), gapped, row)

    return F.when(context != "", bound(outwards, made)).otherwise(F.expr("cast(array() as array<struct<pattern:string,root:string,wide:boolean>>)"))


def discovered(words: DataFrame, rounds: int = 2, min_support: int = 5, min_trust: float = 0.5, min_score: float = 0.7, sure: float = 0.9) -> DataFrame:
    """(value, kind): identifiers that the base patterns miss, of words(value, left, right, kind, seed).

    Seeds are the values that base patterns matched. Lexical patterns are the lexical_patterns() of the words before and
    after a value. A pattern scores, for a kind, the mean score of the different values it stands beside (others count 0), and
    counts only with min_support such values and a mean of min_trust. Of the patterns of one root beside a value the best
    wide one speaks, be it for or against, if any of them stands beside min_support different values; the narrow one speaks
    where none does, or if its own score is sure or more. A value scores 1 less the product of the doubts its roots leave,
    and is taken from min_score on: one pattern that mostly stands beside such identifiers is enough, as are two that
    do so every other time. Patterns and values score each other in turns over the graph of their different pairs; the graph is
    one checkpointed table with a row per pair, aggregated before each shuffle. A value's repeats count once.
    """
    patterns_of = F.concat(*[lexical_patterns(F.col(c), c) for c in ("left", "right")])
    pairs = cut(words.select("value", "kind", "seed", F.explode(patterns_of).alias("p")).select("value", "kind", "seed", "p.*").distinct())
    graph = pairs.select("pattern", "value").distinct()
    sizes = cut(graph.groupBy("pattern").agg(F.count("*").alias("size")).where(F.col("size") >= min_support))
    seeds = cut(words.where("seed").select("value", "kind", F.lit(1.0).alias("score")).distinct())
    digits = F.length(_digits(F.col("value")))
    kinds = F.when(F.col("kind") < 2, F.array("kind")).otherwise(F.array_compact(F.array(F.when(digits >= 12, 2), F.when(digits <= 15, 3))))
    open_ = cut(pairs.where("not seed").join(sizes, "pattern", "left_semi").select("pattern", "root", "wide", "value", F.explode(kinds).alias("kind")).distinct())
    scores = seeds
    for _ in range(rounds):
        support = graph.join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("score"), F.count("*").alias("support")).where(F.col("support") >= min_support)
        patterns = support.join(sizes, "pattern").select("pattern", "kind", (F.col("score") / F.col("size")).alias("trust")).where(F.col("trust") >= min_trust)
        best = lambda wide: F.max(F.when(F.col("wide") == wide, F.coalesce("trust", F.lit(0.0))))
        roots = open_.join(patterns, ["pattern", "kind"], "left").groupBy("value", "kind", "root").agg(best(True).alias("wide"), best(False).alias("narrow"))
        trust = F.when(F.col("wide").isNull() | (F.col("narrow") >= sure), F.greatest("wide", "narrow")).otherwise(F.col("wide"))
        doubt = F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-9))))
        new = roots.select("value", "kind", trust.alias("trust")).where(F.col("trust") >= min_trust).groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score")).where(F.col("score") >= min_score)
        scores = cut(seeds.unionByName(new).groupBy("value", "kind").agg(F.max("score").alias("score")))
    unseen = scores.join(seeds.select("value").distinct(), "value", "left_anti")
    return unseen.groupBy("value").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"))


def find_personal_data(docs: DataFrame, rounds: int = 2, min_support: int = 5, min_trust: float = 0.5, min_score: float = 0.7) -> DataFrame:
    """(doc_id, base, added) for each row of docs(doc_id, text): spans (start, kind, end) in code points, end exclusive.

    base has the matches of the fixed patterns, per kind from the left and without overlap, that pass their checks;
    added the candidates() that discovered() names. Texts are read once, whole, in time linear in their length but for a
    logarithm; no word, context or span has a longest length. After that only spans with the words beside them move, by
    the number of their row, so that no text, host or copy is a key of its own, whatever its number of rows.

    A null or empty text has no spans; null doc_ids and repeated rows stay; an empty table gives an empty result; other
    columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("seeds", seed_spans(F.col("text")))
    read = cut(named.select("doc_id", F.monotonically_increasing_id().alias("row"), "seeds", candidates(F.col("text"), F.col("seeds")).alias("open")))
    marked = lambda seed: lambda x: F.struct(x.alias("span"), F.lit(seed).alias("seed"))
    tagged = F.concat(F.transform("seeds", marked(True)), F.transform("open", marked(False)))
    words = read.select("row", F.explode(tagged).alias("w")).select("row", "w.seed", "w.span.*").withColumn("value", F.lower("hit"))
    new = discovered(words.select("value", "left", "right", "kind", "seed"), rounds, min_support, min_trust, min_score)
    spans = words.where("not seed").select("row", "value", "start", "end").join(new, "value").groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("added"))
    base = F.transform("seeds", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    joined = read.select("doc_id", "row", base.alias("base")).join(cut(spans), "row", "left")
    return joined.select("doc_id", "base", F.coalesce("added", F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")).alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined, by start and then kind."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column) -> list[Column]:
    of = lambda k: F.filter(spans, lambda s: s["kind"] == k)
    return [F.size(of(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
