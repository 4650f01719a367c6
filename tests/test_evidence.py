"""What an article's places say, and how they are weighed."""

from eventloom.plans.coding import Dimensions, agent_to_code, article_roles

SCHEMA = "title string, short_desc string, intro_para string, redirects array<string>, alternative_names array<string>, affiliated_people array<string>, box_type string, infobox map<string,string>, categories array<string>"
FILLER = " It has been described at length in many books by many people over the years."


def _dims(spark):
    roles = spark.createDataFrame([("police", "COP", ""), ("minister", "GOV", ""), ("army", "MIL", "")], "pattern string, code_1 string, code_2 string")
    return Dimensions([("French(?=[^a-z]|$)", "FRA"), ("France", "FRA"), ("Spain", "ESP"), ("Peru", "PER")], None, roles, [("of France", "FRA"), ("in Peru", "PER")])


def _coded(spark, *articles, dates=("2000-01-01",)):
    rows = [(f"t{i}", a.get("short"), a.get("intro"), [], [], [], a.get("box_type"), a.get("box"), a.get("categories")) for i, a in enumerate(articles)]
    whole = spark.createDataFrame(rows, SCHEMA)
    linked = spark.createDataFrame([(r[0], d) for r in rows for d in dates], "title string, date string")
    out = {}
    for r in article_roles(linked, whole, _dims(spark)).orderBy("title", "date", "pos").collect():
        out.setdefault((r.title, r.date), []).append((r.source, r.code_1, r.country, r.query))
    return out


def test_each_place_speaks(spark):
    found = _coded(
        spark,
        {"intro": "X (born in Spain) is French, later of Peru.\nSpain"},  # earliest country of the first line, brackets left out
        {"box_type": "army", "box": {"country": "Peru"}},
        {"box": {"type": "army"}, "categories": ["People of France", "Rivers in Peru", "Things of France"]},
        {"short": "French police", "intro": "He lives in Spain."},
        {},  # all null
        {"box_type": "", "box": {"office1": "", "country": ""}, "categories": [None, ""], "intro": "", "short": ""},
        {"categories": ["Spain", "old things in Peru"]},
    )
    day = "2000-01-01"
    assert found == {
        ("t0", day): [("Wiki", "", "FRA", "")],
        ("t1", day): [("Infobox Title", "MIL", "PER", "army")],
        ("t2", day): [("Infobox Type", "MIL", "FRA", "army")],
        ("t3", day): [("Wiki short description", "COP", "FRA", "police")],
        ("t6", day): [("Wiki", "", "PER", "")],
    }


def test_offices_by_date_and_a_null_date(spark):
    box = {"office1": "French minister", "term_start1": "1990-01-01", "term_end1": "1999-01-01", "office2": "army", "term_start2": "2005-01-01"}
    found = _coded(spark, {"box": box, "intro": "Of Peru."}, dates=("1995-01-01", "2001-01-01", "2010-01-01", None))
    assert found[("t0", "1995-01-01")] == [("Infobox", "GOV", "FRA", "minister")]
    assert found[("t0", "2001-01-01")] == [("Infobox", "ELI", "PER", "")]  # the offices' country isn't that of the first line
    assert found[("t0", "2010-01-01")][0][:2] == ("Infobox", "MIL")
    assert found[("t0", None)][0][1] == "ELI"


def test_evidence_reaches_the_chain(spark):
    """A town's country from its box, a person's from categories alone."""
    rows = [("Ulm", None, "Ulm is a town." + FILLER, [], [], [], "settlement", {"country": "Spain", "type": "army"}, []), ("Ann", None, "Ann is a person." + FILLER, [], [], [], None, {}, ["People of France"])]
    coded = agent_to_code(spark.createDataFrame([("Ulm", "2000-01-01"), ("Ann", None)], "text string, date string"), _dims(spark), spark.createDataFrame(rows, SCHEMA))
    assert {r.text: (r.country, r.code_1) for r in coded.collect()} == {"Ulm": ("ESP", "MIL"), "Ann": ("FRA", "")}


def test_articles_of_a_small_file_are_dealt_to_all_tasks(spark):
    from eventloom.plans import catalog
    from tests.compare import SF

    plan = catalog.QUERIES["t20_article_evidence"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [title" in plan
