"""Date phrases read from one day, with past and coming dates preferred."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.functions import dates
from eventloom.functions.date_phrases import MONTHS, read_phrase

#: 2012-06-20 is a Wednesday. (phrase, the date with past ones preferred, with coming ones preferred)
PHRASES = [
    ("today", "2012-06-20", "2012-06-20"), ("now", "2012-06-20", "2012-06-20"), ("yesterday", "2012-06-19", "2012-06-19"), ("tomorrow", "2012-06-21", "2012-06-21"),
    ("the day before yesterday", "2012-06-18", "2012-06-18"), ("day after tomorrow", "2012-06-22", "2012-06-22"),
    ("3 days ago", "2012-06-17", "2012-06-17"), ("three days earlier", "2012-06-17", "2012-06-17"), ("two weeks ago", "2012-06-06", "2012-06-06"), ("a month ago", "2012-05-20", "2012-05-20"), ("an year ago", "2011-06-20", "2011-06-20"), ("1 decade ago", "2002-06-20", "2002-06-20"),
    ("5 hours ago", "2012-06-19", "2012-06-19"), ("25 hours ago", "2012-06-18", "2012-06-18"), ("10 minutes ago", "2012-06-19", "2012-06-19"), ("1 year, 2 months ago", "2011-04-20", "2011-04-20"), ("2 weeks and 3 days ago", "2012-06-03", "2012-06-03"),
    ("in 3 days", "2012-06-23", "2012-06-23"), ("in two weeks", "2012-07-04", "2012-07-04"), ("in 5 hours", "2012-06-20", "2012-06-20"), ("two days from now", "2012-06-22", "2012-06-22"), ("3 days", "2012-06-17", "2012-06-23"), ("two months", "2012-04-20", "2012-08-20"),
    ("last week", "2012-06-13", "2012-06-13"), ("last month", "2012-05-20", "2012-05-20"), ("past year", "2011-06-20", "2011-06-20"), ("this week", "2012-06-20", "2012-06-20"), ("next week", "2012-06-27", "2012-06-27"), ("next month", "2012-07-20", "2012-07-20"),
    ("Sunday", "2012-06-17", "2012-06-24"), ("on Sunday", "2012-06-17", "2012-06-24"), ("last Sunday", "2012-06-17", "2012-06-24"), ("Wednesday", "2012-06-13", "2012-06-27"), ("Thurs.", "2012-06-14", "2012-06-21"), ("this Monday", "2012-06-18", "2012-06-25"),
    ("May 2019", "2019-05-20", "2019-05-20"), ("in May 2019", "2019-05-20", "2019-05-20"), ("May", "2012-05-20", "2013-05-20"), ("July", "2011-07-20", "2012-07-20"), ("last July", "2011-07-20", "2012-07-20"), ("2018", "2018-06-20", "2018-06-20"), ("in 2018", "2018-06-20", "2018-06-20"),
    ("5 May", "2012-05-05", "2013-05-05"), ("May 5", "2012-05-05", "2013-05-05"), ("the 5th of May", "2012-05-05", "2013-05-05"), ("March 3rd", "2012-03-03", "2013-03-03"), ("December 5", "2011-12-05", "2012-12-05"), ("June 20", "2012-06-20", "2012-06-20"), ("Monday, May 4", "2012-05-04", "2013-05-04"), ("February 29", "2012-02-29", "2016-02-29"),
    ("May 4 2020", "2020-05-04", "2020-05-04"), ("Mon, 4 May 2020", "2020-05-04", "2020-05-04"), ("Sept. 9, 2019", "2019-09-09", "2019-09-09"), ("June 1st, 2010", "2010-06-01", "2010-06-01"), ("2020-05-04T10:00:00", "2020-05-04", "2020-05-04"), ("2020-05-04 10:00:00.5+02:00", "2020-05-04", "2020-05-04"), ("2020/5/4", "2020-05-04", "2020-05-04"), ("20200504", "2020-05-04", "2020-05-04"), ("05/04/2020", "2020-05-04", "2020-05-04"), ("May 4, 2020 at 3:15 pm", "2020-05-04", "2020-05-04"),
    ("the 15th", "2012-06-15", "2012-07-15"), ("the 31st", "2012-05-31", "2012-07-31"),
    ("February 30", None, None), ("2019-02-29", None, None), ("2020-13-01", None, None), ("some day", None, None), ("ago", None, None), ("May June", None, None), ("5 6 2019 7", None, None), ("next Friday", None, None), ("yesterday in May", None, None), ("", None, None), ("12345", None, None), ("99 May", None, None), ("in", None, None), ("last", None, None), ("3.5 days ago", None, None),
]


def test_table_of_phrases(spark):
    rows = spark.createDataFrame([(p, datetime.date(2012, 6, 20)) for p, _, _ in PHRASES], "raw string, base date")
    read = rows.select("raw", "base", dates.read_phrases(F.col("raw")).alias("p"))
    told = [F.date_format(dates.resolve_phrase(F.col("p"), F.col("base"), ahead), "yyyy-MM-dd") for ahead in (False, True)]
    assert [(r[0], r[1], r[2]) for r in read.select("raw", *told).collect()] == PHRASES


@pytest.mark.parametrize(
    ("raw", "published", "expected", "told"),
    [
        (None, "June 20, 2012", "2012-06-20", dates.NO_PHRASE), ("next Friday", "2012-06-20", "2012-06-22", "Friday"), ("3 days later", "2012-06-20", "2012-06-23", "3 days"), ("next week", "2012-06-20", "2012-06-27", "next week"), ("later this week", "2012-06-20", "2012-06-20", "this week"),
        ("who knows", "20 June 2012", "20 June 2012", dates.NOT_A_DATE), ("yesterday", "no date", "no date", dates.NOT_A_DATE), (None, "no date", "no date", dates.NO_PHRASE), ("yesterday", None, None, dates.NOT_A_DATE), ("May 4 2020", None, "2020-05-04", "May 4 2020"), ("yesterday", "2012-06-20T08:00:00Z", "2012-06-19", "yesterday"),
    ],
)
def test_resolve_dates(spark, raw, published, expected, told):
    row = dates.resolve_dates(spark.createDataFrame([(raw, published)], "raw string, published string"), "raw", "published").first()
    assert (row.date_resolved, row.date_raw) == (expected, told)


@settings(max_examples=200, deadline=None)
@given(st.dates(datetime.date(1900, 1, 1), datetime.date(2100, 12, 31)))
def test_dates_in_full(d):
    month = MONTHS[d.month - 1].title()
    for text in (d.isoformat(), f"{month} {d.day}, {d.year}", f"{d.day} {month[:3]} {d.year}", f"{d.month}/{d.day}/{d.year}", d.strftime("%Y%m%d"), d.strftime("%A, %B %d, %Y")):
        p = read_phrase(text)
        assert (p.year, p.month, p.day) == (d.year, d.month, d.day)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_any_text(text):
    read_phrase(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("last next this in a 3 12 2019 may monday ago week days before yesterday day from now 5th of 10:30 later 99999999999999 after tomorrow".split()), max_size=7))
def test_any_words(words):
    p = read_phrase(" ".join(words))
    assert p is None or p.is_dated() != (p.direction is not None)


def test_many_rows_and_an_empty_table(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.concat((F.col("id") % 7 + 1).cast("string"), F.lit(" days ago"))).alias("raw"), F.lit("2012-06-20").alias("published"))
    assert dates.resolve_dates(rows, "raw", "published").groupBy("date_resolved").count().count() == 8
    assert dates.resolve_dates(rows.where("false"), "raw", "published").count() == 0
