"""Dates in texts, resolved against a date of publication."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import astuple, fields

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.date_phrases import SCHEMA, Phrase, read_phrase

#: Fixed domain values: what stands for a phrase that is missing or means no date.
NO_PHRASE = "<No date detected--using publication date>"
NOT_A_DATE = "<dateparser failed to convert relative date--using pub date>"
#: So many years are looked through for a leap day, and so many months for one that has a day.
YEARS, LATER_MONTHS = 9, 3


def _read(texts: pa.Array) -> pa.Array:
    """Each different phrase of a batch is read once."""
    coded = texts.dictionary_encode()
    found = [read_phrase(t) for t in coded.dictionary.to_pylist()]
    columns = list(zip(*[astuple(p) if p else (None,) * len(fields(Phrase)) for p in found])) or [()] * len(fields(Phrase))
    valid = pa.array([p is None for p in found], pa.bool_())
    return pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in columns], [f.name for f in fields(Phrase)], mask=valid).take(coded.indices)


def read_phrases(text: Column) -> Column:
    """What date phrases say (date_phrases.Phrase), as a struct; null if they say no date."""
    return F.arrow_udf(_read, SCHEMA)(text)


def _bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), lambda x: f(x)), F.lit(0))


def _day(year: Column, month: Column, day: Column) -> Column:
    """A date, or null if there is no such day."""
    return F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), "yyyy-MM-dd")


def _clipped(year: Column, month: Column, base: Column) -> Column:
    """The day of base in another month, or that month's last."""
    return _bind(_day(year, month, F.lit(1)), lambda first: F.date_add(first, F.least(F.dayofmonth(base), F.dayofmonth(F.last_day(first))) - 1))


def resolve_phrase(p: Column, base: Column, future: bool = False) -> Column:
    """The date that a phrase means, told from base; null without either, or if there is no such day.

    What a phrase leaves open is as in base (the day is the month's last where it has fewer). Without a year it is the
    last such date that isn't after base, with future the first that isn't before it; a weekday by itself is never base.
    A weekday beside a date isn't held against it. A distance without a direction lies in the past, with future ahead; base is its
    day's beginning, so that an hour ago is the day before.
    """
    sign = F.when(p["direction"] == 0, 1 if future else -1).otherwise(p["direction"])
    seconds = F.when(sign < 0, -F.ceil(p["seconds"] / 86400)).otherwise(F.floor(p["seconds"] / 86400)).cast("int")
    distant = F.date_add(F.add_months(base, sign * p["months"]), sign * p["days"] + seconds)
    apart = F.pmod((p["weekday"] - F.dayofweek(base)) if future else (F.dayofweek(base) - p["weekday"]), F.lit(7))
    weekday = _bind(F.when(apart == 0, 7).otherwise(apart), lambda d: F.date_add(base, d) if future else F.date_sub(base, d))
    step = 1 if future else -1

    def reached(day: Column) -> Column:
        return _bind(day, lambda d: F.when((d >= base) if future else (d <= base), d))

    def in_year(year: Column) -> Column:
        return F.when(p["day"].isNotNull(), _day(year, p["month"], p["day"])).otherwise(_clipped(year, p["month"], base))

    leap_day = F.when((p["month"] == 2) & (p["day"] == 29), F.get(F.filter(F.transform(F.sequence(F.lit(0), F.lit(YEARS - 1)), lambda k: reached(_day(F.year(base) + step * k, F.lit(2), F.lit(29)))), lambda d: d.isNotNull()), F.lit(0)))
    of_years = F.coalesce(*[reached(in_year(F.year(base) + step * k)) for k in range(2)], leap_day)
    of_months = F.coalesce(*[reached(_bind(F.add_months(F.trunc(base, "month"), step * k), lambda m: _day(F.year(m), F.month(m), p["day"]))) for k in range(LATER_MONTHS)])
    month = F.coalesce(p["month"], F.month(base))
    full = F.when(p["day"].isNotNull(), _day(p["year"], month, p["day"])).otherwise(_clipped(p["year"], month, base))
    return F.when(p["direction"].isNotNull(), distant).when(p["year"].isNotNull(), full).when(p["month"].isNotNull(), of_years).when(p["day"].isNotNull(), of_months).otherwise(weekday)


def resolve_dates(rows: DataFrame, raw: str, published: str) -> DataFrame:
    """rows with date_resolved and date_raw: the date a phrase means, read from the date of publication, as YYYY-MM-DD.

    Without a phrase it is the publication date. A phrase that means no date before it is tried again without next or
    later and then means a coming one; if that fails too, the publication date stands as it was written. Phrases are read
    in one Arrow pass; dates are told from them by column expressions, each a column of its own so that it is computed once.
    """
    phrase, base = F.col(raw), F.col("_base")
    bare = F.when(phrase.rlike("next|later"), F.trim(F.regexp_replace(phrase, "next|later", "")))
    read = rows.withColumn("_bare", bare).withColumns({"_published": read_phrases(F.col(published)), "_said": read_phrases(phrase), "_ahead": read_phrases(F.col("_bare"))})
    based = read.withColumn("_base", _day(F.col("_published.year"), F.col("_published.month"), F.col("_published.day")))
    known = based.withColumns({"_known": resolve_phrase(F.col("_said"), base), "_coming": resolve_phrase(F.col("_ahead"), base, future=True)})
    written = lambda d: F.date_format(d, "yyyy-MM-dd")
    resolved = F.coalesce(written(F.when(phrase.isNull(), base).otherwise(F.coalesce("_known", "_coming"))), F.col(published))
    told = F.when(phrase.isNull(), NO_PHRASE).when(F.col("_known").isNotNull(), phrase).when(F.col("_coming").isNotNull(), F.col("_bare")).otherwise(NOT_A_DATE)
    return known.withColumns({"date_resolved": resolved, "date_raw": told}).drop("_bare", "_published", "_said", "_ahead", "_base", "_known", "_coming")


def in_force(start: Column, end: Column, when: Column) -> Column:
    """Whether a term was running: it began before, and hasn't ended or ends after; false without a beginning."""
    return F.coalesce((start < when) & (end.isNull() | (end > when)), F.lit(False))
