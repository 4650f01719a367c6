"""Golden cases of the operators that the star tables can't show."""

import pytest
from pyspark.sql import functions as F

from eventloom.operators import actors, events, knowledge
from eventloom.plans.coding import Dimensions, agent_to_code
from eventloom.sources import readers


@pytest.mark.parametrize(
    ("types", "modes", "expected"),
    [
        (["PROTEST"], [], [("PROTEST", "", "7_PROTEST_")]),
        (["ASSAULT"], ["ASSAULT-airstrike"], [("ASSAULT", "airstrike", "7_ASSAULT_airstrike")]),
        (["CONSULT"], ["CONSULT-third-party"], [("CONSULT", "third-party", "7_CONSULT_third-party")]),
        (["ACCUSE"], ["ACCUSE-disapprove", "ACCUSE-allege"], [("ACCUSE", "disapprove", "7_ACCUSE_disapprove"), ("ACCUSE", "allege", "7_ACCUSE_allege")]),
        (["AID"], ["ACCUSE-allege"], [("AID", "", "7_AID_")]),
        (["AID"], ["AID"], [("AID", "", "7_AID_")]),
        ([], ["AID-x"], []),
        (["AID"], [""], [("AID", "", "7_AID_")]),
        (["AID"], None, [("AID", "", "7_AID_")]),
        (None, ["AID-x"], []),
    ],
)
def test_lengthen(spark, types, modes, expected):
    df = spark.createDataFrame([("7", types, modes)], "id string, event_type array<string>, event_mode array<string>")
    assert [(r.event_type, r.event_mode, r.id) for r in events.lengthen_stories(df).collect()] == expected


@pytest.mark.parametrize(
    ("loc", "geo", "overlap", "found"),
    [((148, 156), [(148, 156, 1.0)], 1.0, True), ((0, 10), [(0, 5, 0.9)], 0.5, True), ((0, 10), [(8, 20, 1.0)], 0.1, False), ((0, 4), [(0, 4, 0.85)], 1.0, False), (None, [], None, False), ((0, 4), [], None, False), ((0, 4), None, None, False), ((0, 4), [(0, 4, None)], 1.0, True)],
)
def test_location(spark, loc, geo, overlap, found):
    schema = "event_id int, loc struct<text:string,start_char:int,end_char:int>, geo_ents array<struct<start_char:int,end_char:int,score:double>>"
    row = events.match_location(spark.createDataFrame([(1, loc and ("x", *loc), geo)], schema)).first()
    assert (row.overlap, row.geo is not None) == (pytest.approx(overlap, abs=0.02) if overlap else overlap, found)


PATTERNS = [("British(?=[^a-z]|$)", "GBR"), ("Great Britain", "GBR"), ("Britain", "GBR"), ("Saudi(?=[^a-z]|$)", "SAU"), ("Saudi Arabia", "SAU"), ("China", "CHN"), ("Republic of China", "TWN"), ("People's Republic of China", "CHN"), ("American(?=[^a-z]|$)", "USA"), ("Niger", "NER"), ("Nigeria", "NGA"), ("Kyiv", "UKR"), ("Cote d.Ivoire", "CIV"), ("Abkhazia", "GEOPRE")]


@pytest.mark.parametrize(
    ("given_text", "country", "rest"),
    [("Great Britain", "GBR", ""), ("Republic of China", "TWN", ""), ("People's Republic of China", "CHN", ""), ("Saudi Arabia", "SAU", ""), ("an American destroyer", "USA", "an destroyer"), ("four Saudi men", "SAU", "four men"), ("Nigeria", "NGA", ""), ("Americans", None, "Americans"), ("Côte d’Ivoire", "CIV", ""), ("", None, ""), (None, None, None)],
)
def test_find_country(spark, given_text, country, rest):
    row = actors.find_country(spark.createDataFrame([(given_text,)], "text string"), PATTERNS).first()
    assert (row.country, row.rest) == (country, rest)


@pytest.mark.parametrize(("code", "country", "expected"), [("JNK", "USA", ("JNK", "")), ("NON", "USA", ("NON", "")), ("IGO", "x", ("", "IGO")), ("GOV", None, ("GOV", "")), ("", "UKRPRE", ("PRE", "UKR")), ("GOV", "USA", ("GOV", "USA"))])
def test_clean_best(spark, code, country, expected):
    row = actors.clean_best(spark.createDataFrame([(code, country)], "code_1 string, country string")).first()
    assert (row.code_1, row.country) == expected


def _articles(spark):
    schema = readers.ARTICLE.replace(", update date", "")
    office = {"name": "Angela Merkel", "office": "Chancellor of Germany", "term_start": "2005-11-22", "term_end": "2021-12-08"}
    intro = "Angela Merkel is a retired politician who led a large country for many years and more than that."
    return spark.createDataFrame([("Angela Merkel", "Former politician", intro, ["Merkel"], ["A. Merkel"], [], "officeholder", office, [])], schema)


def test_agent_to_code(spark):
    """Codes depend on the date; what names neither a role, a country nor an article has none."""
    expected = {
        ("Angela Merkel", "2017-04-01"): ("DEU", "GOV"), ("Angela Merkel", "2022-01-10"): ("DEU", "ELI"), ("Kyiv police", "2022-01-10"): ("UKR", "COP"), ("Abkhazia", "2022-01-10"): ("GEO", "PRE"), ("Great Britain", "2022-01-10"): ("GBR", ""),
        ("a cat named Frank", "2022-01-10"): None, ("Frank", "2022-01-10"): None, ("a cat", "2022-01-10"): None,
    }
    dims = Dimensions([*PATTERNS, ("Germany", "DEU")], None, spark.createDataFrame([("police", "COP", ""), ("chancellor", "GOV", "")], "pattern string, code_1 string, code_2 string"))
    rows = agent_to_code(spark.createDataFrame(list(expected), "text string, date string"), dims, _articles(spark)).collect()
    assert {(r.text, r.date): (r.country, r.code_1) for r in rows} == {k: v for k, v in expected.items() if v}


def test_entity_parts_are_sorted_sets(spark):
    df = spark.createDataFrame([(1, [("B", "PERSON"), ("A", "PERSON"), ("B", "PERSON"), ("X", "GPE"), ("Y", "DATE")])], "doc_position long, ents array<struct<text:string,label:string>>")
    row = events.entity_sets(df).first()
    assert (row.story_people, row.story_organizations, row.story_places) == (["A", "B"], [], ["X"])


def test_majority_takes_the_first_seen_of_equals(spark):
    df = spark.createDataFrame([(1, 0, "B"), (1, 1, "A"), (1, 2, "A"), (1, 3, "B"), (1, 4, ""), (1, 5, None)], "k int, pos int, v string")
    assert actors.majority(df, ["k"], "v", "pos").first().v == "B"


def test_required_columns(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="missing columns"):
        readers.require_columns(df, ["event"])
    with pytest.warns(UserWarning, match="mode"):
        readers.require_columns(df, ["id"], ["mode"])


def test_markup_with_nested_braces(spark):
    page = "{{Infobox x {{y}}\n| name = A [[b|c]]\n| founder = {{plainlist|\n* D}}\n}}\n'''A''' is long. {{cite|x}}\n== H ==\n"
    row = knowledge.parse_markup(spark.createDataFrame([("t", page), ("u", None)], "title string, text string")).orderBy("title").collect()
    assert row[0].infobox["name"] == "A [[b|c]]" and row[0].bold == ["A"] and row[0].intro_para == "A is long."
    assert row[1].box_type is None


def test_search_nat_rejects_other_methods(spark):
    with pytest.raises(ValueError):
        actors.find_country(spark.range(1).select(F.lit("x").alias("text")), [], "shortest")


def test_zipped_csv(spark, tmp_path):
    import zipfile

    for k in range(2):
        with zipfile.ZipFile(tmp_path / f"{k}.zip", "w") as archive:
            archive.writestr("x.csv", f'id,text,label\n{k},"a, b",\n')
    rows = readers.read_zipped_csv(spark, f"{tmp_path}/*.zip", "id long, text string, label string").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(0, "a, b", None), (1, "a, b", None)]
