"""Winnowing: every window of a text names one short run inside it (its anchor), and equal windows name equal runs at equal places."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from eventloom.llm.common import mixed, prefix_sums, range_hashes, rolling


class Segments(NamedTuple):
    """Runs of consecutive windows with one anchor: windows first .. last, the anchor's place and its hash."""

    first: np.ndarray
    last: np.ndarray
    place: np.ndarray
    anchor: np.ndarray


def anchored_segments(symbols: np.ndarray, window: int, run: int) -> Segments:
    """The windows of symbols, grouped by anchor. An anchor is the run of the least hash in the window, the rightmost of equal ones.

    About 2 / (window - run + 2) of the symbols begin an anchor. Hashes keep their upper 40 bits when compared; the rest
    holds the place, so a text may have 2**24 symbols; longer ones are cut by the caller.
    """
    hashes = rolling(symbols, run)
    n = len(symbols) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Segments(none, none, none, np.zeros(0, np.uint64))
    low = np.uint64((1 << 24) - 1)
    keyed = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    width, done = window - run + 1, 1
    while 2 * done <= width:  # least of ever longer stretches
        keyed = np.minimum(keyed[:-done], keyed[done:])
        done *= 2
    if done < width:
        keyed = np.minimum(keyed[: len(keyed) - (width - done)], keyed[width - done :])
    place = (low - (keyed & low)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:] - 1, n - 1)
    return Segments(first, last, place[first], hashes[place[first]])


def contents(symbols: np.ndarray, segments: Segments, window: int) -> np.ndarray:
    """Names each segment's whole stretch of symbols together with the anchor's place in it."""
    found = range_hashes(prefix_sums(symbols), segments.first, segments.last + window)
    shape = (segments.place - segments.first).astype(np.uint64) << np.uint64(32) | (segments.last - segments.first).astype(np.uint64)
    return mixed(found + mixed(shape))
