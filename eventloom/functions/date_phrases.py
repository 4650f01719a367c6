"""A grammar of English date phrases: what a phrase says, before it is held against any date."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields

MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
WEEKDAYS = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]
NUMBERS = {"a": 1, "an": 1, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12}
#: Months, days and seconds of a unit.
UNITS = {
    "second": (0, 0, 1), "sec": (0, 0, 1), "minute": (0, 0, 60), "min": (0, 0, 60), "hour": (0, 0, 3600), "hr": (0, 0, 3600),
    "day": (0, 1, 0), "week": (0, 7, 0), "month": (1, 0, 0), "year": (12, 0, 0), "decade": (120, 0, 0),
}
#: Days from now, past ones negative.
NAMED_DAYS = {"today": 0, "tonight": 0, "now": 0, "yesterday": -1, "tomorrow": 1}
PAST, FUTURE = {"ago", "earlier", "before"}, {"hence"}
NEAR = {"last": -1, "past": -1, "previous": -1, "this": 0, "next": 1}
FILLERS = {"on", "the", "of", "at", "and", "in", "utc", "gmt", "z"}

_MONTHS = {name: k for k, m in enumerate(MONTHS, 1) for name in (m, m[:3])} | {"sept": 9}
_WEEKDAYS = {name: k for k, d in enumerate(WEEKDAYS, 1) for name in (d, d[:3])} | {"tues": 3, "thur": 5, "thurs": 5}
_UNITS = {name: span for u, span in UNITS.items() for name in (u, f"{u}s")}
_TOKEN = re.compile(
    r"(?P<iso>\d{4}[-/]\d{1,2}[-/]\d{1,2})(?:t?\s*(?=\d{1,2}:\d)|(?!\d))|(?P<clock>\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:\s*[ap]\.?m\b\.?)?(?:[+-]\d{2}:?\d{2})?)"
    r"|(?P<slashes>\d{1,2}[-/]\d{1,2}[-/]\d{4})(?!\d)|(?P<compact>\d{8})(?!\d)|(?P<ordinal>\d{1,2})(?:st|nd|rd|th)\b|(?P<number>\d{1,4})(?![\d.])|(?P<word>[a-z]+)\.?|(?P<gap>[\s,]+)"
)


@dataclass
class Phrase:
    """Parts of a date that a phrase names, or a distance from now.

    weekday counts from 1, Sunday. months, days and seconds are how far away it is, direction where: -1 before now, 1
    after it, 0 not said; without a distance direction is None.
    """

    year: int | None = None
    month: int | None = None
    day: int | None = None
    weekday: int | None = None
    months: int = 0
    days: int = 0
    seconds: int = 0
    direction: int | None = None

    def is_dated(self) -> bool:
        return any(x is not None for x in (self.year, self.month, self.day, self.weekday))


SCHEMA = "struct<" + ", ".join(f"{f.name}: int" for f in fields(Phrase)) + ">"


def _tokens(text: str) -> list[tuple[str, str]] | None:
    """Kinds and texts of a phrase's tokens; None if something in it is none."""
    out, at, low = [], 0, text.lower()
    while at < len(low):
        m = _TOKEN.match(low, at)
        if m is None:
            return None
        if m.lastgroup != "gap":
            out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Reader:
    """Reads tokens from left to right. Each step takes the longest form that begins there; one that none takes ends it."""

    def __init__(self, tokens: list[tuple[str, str]]):
        self.tokens, self.at, self.phrase = tokens, 0, Phrase()

    def peek(self, ahead: int = 0) -> tuple[str, str]:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ("end", "")

    def word(self, ahead: int = 0) -> str:
        kind, text = self.peek(ahead)
        return text if kind == "word" else ""

    def put(self, **parts: int) -> bool:
        """Fills parts; False if one is filled already."""
        for name, value in parts.items():
            if getattr(self.phrase, name) is not None:
                return False
            setattr(self.phrase, name, value)
        return True

    def move(self, span: tuple[int, int, int], n: int, direction: int | None = None) -> bool:
        p = self.phrase
        p.months, p.days, p.seconds = (was + n * more for was, more in zip((p.months, p.days, p.seconds), span))
        if direction is not None and p.direction:
            return False
        p.direction = (p.direction or 0) if direction is None else direction
        return max(p.months, p.days) < 1 << 20 and p.seconds < 1 << 31

    def amount(self) -> int | None:
        kind, text = self.peek()
        return int(text) if kind == "number" else NUMBERS.get(text) if kind == "word" else None

    def step(self) -> bool:
        kind, text = self.peek()
        if kind == "iso" or kind == "slashes" or kind == "compact":
            self.at += 1
            a, b, c = (text[:4], text[4:6], text[6:]) if kind == "compact" else re.split("[-/]", text)
            year, month, day = (c, a, b) if kind == "slashes" else (a, b, c)
            return self.put(year=int(year), month=int(month), day=int(day))
        n = self.amount()
        if n is not None and self.word(1) in _UNITS:
            self.at += 2
            return self.move(_UNITS[self.word(-1)], n)
        if kind == "clock":
            self.at += 1
            return True  # the time of day doesn't change the date
        if kind == "ordinal" or kind == "number":
            self.at += 1
            return self.put(year=int(text)) if len(text) == 4 else len(text) < 3 and int(text) <= 31 and self.put(day=int(text))
        return self.step_word(text)

    def step_word(self, text: str) -> bool:
        follows = self.word(1)
        self.at += 1
        if text in _MONTHS:
            return self.put(month=_MONTHS[text])
        if text in _WEEKDAYS:
            return self.put(weekday=_WEEKDAYS[text])
        if text in NAMED_DAYS:
            return self.move(UNITS["day"], abs(NAMED_DAYS[text]), (NAMED_DAYS[text] > 0) - (NAMED_DAYS[text] < 0))
        if text == "day" and (follows, self.word(1)) in (("before", "yesterday"), ("after", "tomorrow")):
            self.at += 2
            return self.move(UNITS["day"], 2, -1 if follows == "before" else 1)
        if text in NEAR and follows in _UNITS:
            self.at += 1
            return self.move(_UNITS[follows], abs(NEAR[text]), NEAR[text])
        if text in NEAR and text != "next":
            return follows in _WEEKDAYS or follows in _MONTHS or self.amount() is not None
        if text == "in" and self.amount() is not None and self.word(1) in _UNITS:
            self.at += 2
            return self.move(_UNITS[self.word(-1)], self.amount_before(), 1)
        if text in PAST or text in FUTURE or (text == "from" and follows == "now"):
            self.at += text == "from"
            return self.phrase.direction is not None and self.move((0, 0, 0), 0, -1 if text in PAST else 1)
        return text in FILLERS

    def amount_before(self) -> int:
        """The amount that stands before the unit just taken."""
        kind, text = self.tokens[self.at - 2]
        return int(text) if kind == "number" else NUMBERS[text]


def read_phrase(text: str | None) -> Phrase | None:
    """What a phrase says; None if it says no date: if it holds anything that isn't one, or says two things at once."""
    tokens = _tokens(text.strip()) if text else None
    if not tokens:
        return None
    reader = _Reader(tokens)
    while reader.at < len(tokens):
        if not reader.step():
            return None
    p = reader.phrase
    if p.is_dated() == (p.direction is not None):
        return None
    return p if p.month is None or 1 <= p.month <= 12 else None
