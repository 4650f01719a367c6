"""Parts of a mention: who it names, in which role, and where."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed domain values: labels of places, and words that mark a role.
PLACES = ["GPE", "LOC", "FAC", "NORP"]
ROLE_WORDS = ["official", "president", "mayor", "secretary", "minister", "member", "council", "general", "party", "service", "airport", "police", "attacker", "right-wing", "wing"]
#: Fixed domain values: what each feature of a phrase adds to its score as a role. words counts up to three.
ROLE_WEIGHTS = {"keyword": 5, "words": 1, "leads": 2, "tiny": -2}
#: Fixed domain values: words that a role takes over from its mention, and what the role must hold for that.
COMPLETIONS = {"party": "wing", "airport": "", "service": "", "council": ""}
_OWNED = r"([A-Za-z']+)['’]s\s+([A-Za-z]+)"


def _literal(word: Column) -> Column:
    """A regular expression for the word as it stands, not inside a longer word; for null one that matches nothing."""
    quoted = F.concat(F.lit("\\b\\Q"), F.replace(word, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E\\b"))
    return F.coalesce(quoted, F.lit(r"(?!)"))


def role_phrase(text: Column, place: Column) -> Column:
    """A phrase as a role: no place, no possessive ending, single spaces, and no mark or "of" left over at its edges."""
    words = F.split(F.regexp_replace(text, F.concat(_literal(place), F.lit(r"|['’]s(?=\s)")), F.lit(" ")), r"\s+")
    return F.regexp_replace(F.array_join(words, " "), r"^[ ‘’]+|(?: of)?[ ,.:;]*$|^of$", "")


def role_features(phrase: Column, mention: Column) -> Column:
    """What speaks for a phrase as the role in a mention: a struct with a number for each of ROLE_WEIGHTS."""
    low = F.lower(phrase)
    return F.struct(
        F.exists(F.array(*map(F.lit, ROLE_WORDS)), lambda w: F.contains(low, w)).cast("int").alias("keyword"),
        F.least(F.size(F.split(phrase, " ")), F.lit(3)).alias("words"),
        F.startswith(F.lower(mention), low).cast("int").alias("leads"),
        (F.length(phrase) < 3).cast("int").alias("tiny"),
    )


def split_mentions(mentions: DataFrame) -> DataFrame:
    """mentions with core_entity, role and geographic_info.

    mentions has text, ents(text, label) in order and appositives, the texts of appositive phrases. The place is the first
    place. The core is, of these, the first there is: the organization that the place owns ("Iran's IRGC"), a person, an
    organization; a word in capitals is one too. A role is a phrase beside core and place: an appositive, a stretch that
    neither covers, what leads up to a person, what follows an organization. Of these, as role_phrase(), the one with the
    greatest weighted sum of role_features() is taken, the first of equal ones; then COMPLETIONS are added. A mention
    without entities has neither core nor place; without phrases it has no role.
    """
    text, place, core, role = (F.col(c) for c in ("text", "geographic_info", "core_entity", "role"))
    named = lambda *labels: F.transform(F.filter("ents", lambda e: e["label"].isin(*labels)), lambda e: e["text"])
    read = mentions.withColumns({
        "geographic_info": F.get(named(*PLACES), F.lit(0)),
        "_people": named("PERSON"),
        "_groups": F.array_distinct(F.concat(named("ORG"), F.regexp_extract_all("text", F.lit(r"\b([A-Z]{2,})\b"), F.lit(1)))),
    })
    owner, owned = F.regexp_extract(text, _OWNED, 1), F.regexp_extract(text, _OWNED, 2)
    ours = F.when(owner == place, F.get(F.filter("_groups", lambda g: F.contains(g, owned)), F.lit(0)))
    cored = read.withColumn("core_entity", F.coalesce(ours, F.get("_people", F.lit(0)), F.get("_groups", F.lit(0))))

    at = F.instr(text, core)
    beside = F.filter(F.transform(F.split(text, F.concat_ws("|", _literal(core), _literal(place))), lambda s: F.regexp_replace(s, "^[ ,]+|[ ,]+$", "")), lambda s: F.length(s) > 1)
    sources = F.concat(
        F.filter(F.coalesce("appositives", F.expr("array()")), lambda a: ~F.coalesce(F.contains(a, core), F.lit(False))),
        beside,
        F.array(F.when(F.array_contains("_people", core), F.substring(text, F.lit(1), at - 1)), F.when(F.array_contains("_groups", core), F.substr(text, at + F.length(core)))),
    )
    phrases = F.filter(F.transform(F.array_compact(sources), lambda s: role_phrase(s, place)), lambda p: p != "")
    weighed = lambda f: reduce(lambda total, n: total + f[n] * ROLE_WEIGHTS[n], ROLE_WEIGHTS, F.lit(0))
    listed = cored.withColumn("_phrases", phrases).withColumn("_features", F.transform("_phrases", lambda p: role_features(p, text)))
    best = F.array_max(F.transform("_features", lambda f, i: F.struct(weighed(f).alias("score"), (-i).alias("before"))))
    found = listed.withColumn("role", F.get("_phrases", -best["before"]))
    for word, condition in COMPLETIONS.items():
        lacks = F.contains(F.lower(text), F.lit(word)) & F.contains(F.lower(role), F.lit(condition)) & ~F.contains(F.lower(role), F.lit(word))
        found = found.withColumn("role", F.when(lacks, F.concat(role, F.lit(f" {word}"))).otherwise(role))
    return found.drop("_people", "_groups", "_phrases", "_features")


def ranking_text(articles: DataFrame, fields: list[str]) -> Column:
    """The text by which articles are compared: the first line of each string field, lists joined by commas, missing ones left out."""
    kinds = dict(articles.dtypes)
    return F.concat_ws(" ", *[F.array_join(f, ", ") if kinds[f].startswith("array") else F.split(F.col(f), "\n")[0] for f in fields])
