"""Many phrases in one pass over a text: an automaton of all of them, for kernels that get Arrow batches."""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache

from ahocorasick import Automaton

Pattern = tuple[str, str]
#: What a pattern may end in beside plain characters: the phrase must not go on in a small letter.
BOUNDARY = "(?=[^a-z]|$)"
_SPECIAL = re.compile(r"[\\.\[\]*+?(){}|^$]")


class Phrases:
    """All spans of patterns in a text.

    A pattern of plain characters, with or without BOUNDARY behind them, is a word of the automaton; a pattern that holds
    anything else of a regular expression (few do) is tried by itself.
    """

    def __init__(self, patterns: tuple[Pattern, ...]):
        self.values = [value for _, value in patterns]
        self.general: list[tuple[int, re.Pattern]] = []
        words: dict[str, list[tuple[int, bool]]] = defaultdict(list)
        for k, (pattern, _) in enumerate(patterns):
            phrase = pattern.removesuffix(BOUNDARY)
            if phrase and not _SPECIAL.search(phrase):
                words[phrase].append((k, phrase != pattern))
            else:
                self.general.append((k, re.compile(pattern)))
        self.automaton = Automaton()
        for phrase, of in words.items():
            self.automaton.add_word(phrase, (len(phrase), of))
        self.automaton.make_automaton()
        self.empty = not words

    def spans(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """The places of each pattern that the text holds, from left to right, without overlaps."""
        found: dict[int, list[tuple[int, int]]] = {}
        for last, (length, of) in () if self.empty else self.automaton.iter(text):
            end = last + 1
            goes_on = end < len(text) and "a" <= text[end] <= "z"
            for k, bounded in of:
                if not (bounded and goes_on):
                    places = found.setdefault(k, [])
                    if not places or places[-1][1] <= end - length:
                        places.append((end - length, end))
        for k, pattern in self.general:
            if places := [m.span() for m in pattern.finditer(text)]:
                found[k] = places
        return found


@lru_cache(maxsize=8)
def compiled(patterns: tuple[Pattern, ...]) -> Phrases:
    """One a worker and list."""
    return Phrases(patterns)


def without(text: str, places: list[tuple[int, int]]) -> str:
    """A text without some of its places, its spaces squeezed."""
    kept, at = [], 0
    for start, end in places:
        kept.append(text[at:start])
        at = end
    kept.append(text[at:])
    return re.sub(" +", " ", "".join(kept).strip()).strip()


def chosen_phrase(text: str | None, patterns: tuple[Pattern, ...] | Phrases, method: str) -> tuple[str | None, str | None]:
    """The value of the pattern that is chosen among those in a text, and the text without it; (None, text) without any."""
    if not text:
        return None, text
    phrases = patterns if isinstance(patterns, Phrases) else compiled(patterns)
    found = phrases.spans(text)
    if not found:
        return None, text
    rests = {k: without(text, places) for k, places in found.items()} if method == "longest" else {}
    best = min(found, key=lambda k: (len(rests[k]) if rests else found[k][0][0], k))
    return phrases.values[best], rests[best] if rests else without(text, found[best])
