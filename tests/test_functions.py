"""Expectations for single expressions."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.functions import dates, spans, text


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("given_text", "expected"),
    [("the ", ""), ("The United States", "United States"), ("President of", "President"), ("101st Airborne", "Airborne"), ("Germany's", "Germany"), ("x", ""), ("", ""), ("a  big\n\nplan", "big plan"), ("'s army", "army"), (None, None)],
)
def test_clean_query(spark, given_text, expected):
    assert one(spark, given_text, text.clean_query) == expected


@pytest.mark.parametrize(("given_text", "expected"), [("o'neil jean-marie", "O'Neil Jean-Marie"), ("", ""), ("éa ÉA", "Éa Éa"), (None, None)])
def test_title_case(spark, given_text, expected):
    assert one(spark, given_text, text.title_case) == expected


def test_fold_accents(spark):
    assert one(spark, "Côte d’Ivoire, Ñandú, é", text.fold_accents) == "Cote d'Ivoire, Nandu, e"


def test_common_subsequence(spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("", "a"), ("abc", "abc")], "a string, b string")
    assert [r.n for r in df.select(text.common_subsequence(F.col("a"), F.col("b")).alias("n")).collect()] == [4, 0, 3]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        (None, "2012-06-20"), ("yesterday", "2012-06-19"), ("last Sunday", "2012-06-17"), ("Wednesday", "2012-06-13"), ("next Friday", "2012-06-22"), ("two weeks ago", "2012-06-06"), ("3 days ago", "2012-06-17"),
        ("a month ago", "2012-05-20"), ("May 5", "2012-05-05"), ("December 5", "2011-12-05"), ("June 1st, 2010", "2010-06-01"), ("1 June 2010", "2010-06-01"), ("2010-06-01", "2010-06-01"), ("who knows", "June 20, 2012"), ("February 30", "June 20, 2012"),
    ],
)
def test_resolve_dates(spark, raw, expected):
    df = spark.createDataFrame([(raw, "June 20, 2012")], "raw string, published string")
    assert dates.resolve_dates(df, "raw", "published").first().date_resolved == expected


def test_in_force(spark):
    d = datetime.date
    df = spark.createDataFrame([(d(2000, 1, 1), None), (d(2000, 1, 1), d(2001, 1, 1)), (None, None), (d(2000, 6, 1), None)], "s date, e date")
    assert [r.y for r in df.select(dates.in_force(F.col("s"), F.col("e"), F.to_date(F.lit("2000-06-01"))).alias("y")).collect()] == [True, True, False, False]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 12)] * 4), min_size=1, max_size=8))
def test_overlap_is_set_overlap(spark, cases):
    cases = [(min(a, b), max(a, b), min(c, d), max(c, d)) for a, b, c, d in cases]
    got = spark.createDataFrame(cases, "a int, b int, c int, d int").select(spans.overlap(*map(F.col, "abcd")).alias("y")).collect()
    for (a, b, c, d), r in zip(cases, got):
        x, y = set(range(a, b)), set(range(c, d))
        assert r.y == pytest.approx(len(x & y) / len(x | y) if x | y else 0)
