"""From stories to coded events: lengthening, entity sets, classifier thresholds, extractor prompts and answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed domain values: the event types, in their fixed order.
EVENT_TYPES = ["ACCUSE", "AGREE", "AID", "ASSAULT", "COERCE", "CONCEDE", "CONSULT", "COOPERATE", "MOBILIZE", "PROTEST", "REJECT", "REQUEST", "RETREAT", "SANCTION", "SUPPORT", "THREATEN"]
ATTRIBUTES = ["actor", "recipient", "date", "location"]


def mode_parts(mode: Column) -> tuple[Column, Column]:
    """Type and rest of a mode code: what stands before and after its first hyphen (the rest is empty without one)."""
    parts = F.split(mode, "-", 2)
    return F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))


def lengthen_stories(stories: DataFrame) -> DataFrame:
    """One row per story, event type and mode of that type; event_type and event_mode become single values.

    A type without any mode of its own makes one row with an empty mode; a mode of no listed type makes none. orig_id
    keeps the story's id, and id becomes id_type_mode. Types and modes that repeat give rows that repeat. Null lists are
    empty ones.
    """
    typed = stories.select("*", F.explode("event_type").alias("_type"))
    own = F.filter(F.coalesce("event_mode", F.expr("array()")), lambda m: mode_parts(m)[0] == F.col("_type"))
    moded = typed.select("*", F.explode_outer(own).alias("_mode"))
    mode = F.coalesce(mode_parts(F.col("_mode"))[1], F.lit(""))
    return moded.withColumns({"orig_id": F.col("id"), "event_mode": mode, "event_type": F.col("_type"), "id": F.concat_ws("_", F.col("id").cast("string"), F.col("_type"), mode)}).drop("_type", "_mode")


def entity_sets(documents: DataFrame) -> DataFrame:
    """doc_position and the different texts of people, organizations and places among ents(text, label), sorted."""
    of = lambda *labels: F.array_sort(F.array_distinct(F.transform(F.filter("ents", lambda e: e["label"].isin(*labels)), lambda e: e["text"])))
    return documents.select("doc_position", of("PERSON").alias("story_people"), of("ORG").alias("story_organizations"), of("GPE", "LOC", "FAC").alias("story_places"))


def attach_documents(stories: DataFrame, documents: DataFrame) -> DataFrame:
    """Stories and their documents, joined on doc_position; a story without a document, or the reverse, is left out."""
    return stories.join(documents, "doc_position")


def types_above(probabilities: Column, threshold: float = 0.6, types: list[str] = EVENT_TYPES) -> Column:
    """The types, in their order, whose probability is over the threshold."""
    pairs = F.arrays_zip(F.array(*map(F.lit, types)).alias("type"), probabilities.alias("p"))
    return F.transform(F.filter(pairs, lambda x: x["p"] > threshold), lambda x: x["type"])


def build_prompt(text: Column, event_def: Column, mode_def: Column, notes: Column) -> Column:
    """The extractor's request: document, event, and the sub-event and special instructions if there are any."""
    optional = lambda head, value: F.when(value.isNotNull(), F.concat(F.lit(f"\n\n### {head}\n"), value)).otherwise("")
    return F.concat(F.lit("### Document\n"), text, F.lit("\n\n### Event\n"), event_def, optional("Specific Sub-Event", mode_def), optional("Special Instructions", notes), F.lit("\n\nAnswer with a JSON list."))


_ANSWER = "array<struct<event_type:string,anchor_quote:string,actor:string,recipient:string,date:string,location:string>>"


def parse_answer(response: Column) -> Column:
    """The extractor's events, each attribute a list of trimmed values; an answer that isn't a JSON list gives null.

    Thoughts are cut out first. An attribute may be a list, or a string whose values are parted by semicolons.
    """
    bare = F.trim(F.regexp_replace(response, r"(?s)<think>.*?</think>", ""))
    events = F.from_json(F.when(bare.startswith("["), bare), _ANSWER)
    values = lambda v: F.when(v.startswith("["), F.from_json(v, "array<string>")).otherwise(F.split(v, ";"))
    return F.transform(events, lambda e: F.struct(e["event_type"].alias("event_type"), e["anchor_quote"].alias("anchor_quote"), *[F.transform(values(e[a]), lambda x: F.trim(x)).alias(a) for a in ATTRIBUTES]))


def parse_answers(answers: DataFrame) -> DataFrame:
    """event_id, events (empty for a bad answer) and failed of answers(event_id, response)."""
    parsed = answers.withColumn("parsed", parse_answer(F.col("response")))
    none = F.from_json(F.lit("[]"), parsed.schema["parsed"].dataType)
    return parsed.select("event_id", F.coalesce("parsed", none).alias("events"), F.col("parsed").isNull().alias("failed"))


#: Names of an attribute in the extractor's answers and in the long table.
LONG_NAMES = {"actor": "ACTOR", "recipient": "RECIP", "location": "LOC", "date": "DATE"}


def attribute_rows(events: DataFrame) -> DataFrame:
    """(event_id, attr_type, pos, text): the attributes of parsed answers as a long table; N/A and blank values are left out."""
    one = events.select("event_id", F.explode("events").alias("e"))
    stacked = F.array(*[F.struct(F.lit(LONG_NAMES[a]).alias("attr_type"), F.col(f"e.{a}").alias("texts")) for a in ATTRIBUTES])
    long = one.select("event_id", F.explode(stacked).alias("a")).select("event_id", "a.attr_type", F.posexplode("a.texts").alias("pos", "text"))
    return long.where("text <> '' and upper(text) <> 'N/A'")


def codebook_lookup(events: DataFrame, codebook: DataFrame) -> DataFrame:
    """Events with event_def, mode_def and extraction_notes of their type and mode; the first codebook row of each key counts.

    The codebook is a dimension of some dozens of rows; Spark broadcasts it by its own size check.
    """
    first = lambda keys: codebook.groupBy(*keys).agg(F.min_by(F.struct("event_def", "mode_def", "extraction_notes"), "ordinal").alias("row"))
    by_type = first(["event"]).select(F.col("event").alias("event_type"), F.col("row.event_def").alias("event_def"))
    by_mode = first(["event", "mode"]).select(F.col("event").alias("event_type"), F.col("mode").alias("event_mode"), "row.mode_def", "row.extraction_notes")
    return events.join(by_type, "event_type", "left").join(by_mode, ["event_type", "event_mode"], "left")


def match_location(events: DataFrame, min_overlap: float = 0.5, min_score: float = 0.85) -> DataFrame:
    """event_id, overlap, reason and geo of events(event_id, loc, geo_ents): the place entity that an event's location span covers.

    loc has text, start_char and end_char; geo_ents are places with start_char, end_char and score. The one with the
    largest intersection over union counts, the first of equal ones; it must reach min_overlap, and its score must be
    over min_score; without a score it is taken.
    """
    return with_location(events, min_overlap, min_score).select("event_id", "overlap", "reason", "geo")


def with_location(events: DataFrame, min_overlap: float = 0.5, min_score: float = 0.85) -> DataFrame:
    """events(loc, geo_ents, ...) with overlap, reason and geo, as in match_location."""
    from eventloom.functions.spans import overlap

    scored = F.transform("geo_ents", lambda g, i: F.struct(overlap(F.col("loc.start_char"), F.col("loc.end_char"), g["start_char"], g["end_char"]).alias("overlap"), (-i).alias("order"), g.alias("geo")))
    best = F.array_max(F.transform(scored, lambda s: F.struct(s["overlap"].alias("overlap"), s["order"].alias("order"))))
    found = events.withColumn("_best", F.when(F.col("loc").isNotNull() & (F.size("geo_ents") > 0), best)).withColumn("_geo", F.get("geo_ents", -F.col("_best.order")))
    reason = (
        F.when(F.col("loc").isNull(), "No location attribute")
        .when(F.col("geo_ents").isNull(), "No place was geolocated: entities are missing")
        .when(F.size("geo_ents") == 0, "No geolocated entities")
        .when(F.col("_best.overlap") < min_overlap, "The location doesn't overlap enough with any place")
        .when(F.col("_geo.score").isNull(), "A place overlaps but has no score")
        .when(F.col("_geo.score") > min_score, "A place overlaps")
        .otherwise("A place overlaps but its score is too low")
    )
    accepted = reason.isin("A place overlaps", "A place overlaps but has no score")
    return found.withColumns({"overlap": F.col("_best.overlap"), "reason": reason, "geo": F.when(accepted, F.col("_geo"))}).drop("_best", "_geo")


def name_places(entities: Column, names: Column) -> Column:
    """Geoparser entities with resolved_placename for name, and country_name by code from a map (null if unknown)."""
    return F.transform(entities, lambda g: g.dropFields("name").withField("resolved_placename", g["name"]).withField("country_name", F.try_element_at(names, g["country_code3"])))


def country_names(attributes: DataFrame, countries: DataFrame) -> DataFrame:
    """Long-table attributes with country_name, empty if unknown, for other types than LOC and DATE (null for those)."""
    joined = attributes.join(countries.select(F.col("code").alias("country"), F.col("name").alias("country_name")), "country", "left")
    return joined.withColumn("country_name", F.when(~F.col("attr_type").isin("LOC", "DATE"), F.coalesce("country_name", F.lit(""))))


def present(events: DataFrame) -> DataFrame:
    """(event_id, attribute, value): what a reader is shown of each event; lists are joined by semicolons, nulls are empty."""
    joined = F.array_join(F.transform("actors", lambda a: F.concat_ws(" ", a["country"], a["code_1"])), "; ")
    texts, wikis = (F.array_join(F.col(f"actors.{n}"), "; ") for n in ("text", "wiki"))
    wide = events.select("event_id", texts.alias("actor_texts"), joined.alias("actor_codes"), wikis.alias("actor_wikis"), F.coalesce("place", F.lit("")).alias("place"))
    return wide.unpivot("event_id", ["actor_texts", "actor_codes", "actor_wikis", "place"], "attribute", "value")
