"""Suffix-array deduplication: repeated byte strings found by difference-cover suffix sorting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import by_batch, cut, rolling
from eventloom.llm.repeats import Unit, consecutive_runs, mixed_contents, remove_repeats, repeated_runs

#: Names and ranks are packed by threes into 64 bits, so a block that is sorted at once must have fewer symbols than 2**BITS.
BITS = 21
#: Symbols at which a block is closed, and those a group may have to be sorted in one block.
BLOCK, GROUP = 1 << 19, 1 << 18


def suffix_ranks(symbols: np.ndarray) -> np.ndarray:
    """Rank of each suffix of symbols (positive integers below 2**BITS), by the difference cover {1, 2} modulo 3.

    Suffixes at places 1 and 2 modulo 3 are sorted by their first three symbols, whose ranks are names; if names repeat,
    the string of names is sorted by recursion. The others are sorted by one symbol and the rank that follows, and
    merged: any two suffixes differ within two symbols or lead to two of the sample.
    """
    n = len(symbols)
    if n < 4:
        order = sorted(range(n), key=lambda i: symbols[i:].tolist())
        ranks = np.empty(n, np.int64)
        ranks[order] = np.arange(n)
        return ranks
    text = np.concatenate([symbols, np.zeros(3, np.int64)])
    end = n + (n % 3 == 1)  # so that the string of names of the first third ends in a name of its own
    sample = np.concatenate([np.arange(1, end, 3), np.arange(2, end, 3)])
    triples, names = np.unique(text[sample] << 2 * BITS | text[sample + 1] << BITS | text[sample + 2], return_inverse=True)
    if len(triples) < len(sample):
        names = suffix_ranks(names + 1)
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = names + 1
    first, second = [s[np.argsort(rank[s])] for s in (np.arange(1, n, 3), np.arange(2, n, 3))]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(text[rest] << BITS | rank[rest + 1])]
    one = lambda at: text[at] << BITS | rank[at + 1]
    two = lambda at: text[at] << 2 * BITS | text[at + 1] << BITS | rank[at + 2]
    ranks = np.empty(n, np.int64)
    ranks[rest] = np.arange(len(rest)) + np.searchsorted(one(first), one(rest)) + np.searchsorted(two(second), two(rest))
    both = np.concatenate([first, second])
    below = np.concatenate([np.searchsorted(one(rest), one(first)), np.searchsorted(two(rest), two(second))])
    order = np.argsort(rank[both])
    ranks[both[order]] = np.arange(len(both)) + below[order]
    return ranks


def equal_neighbours(data: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """Whether each of the sorted places begins the same width bytes as the next one; compared eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    same = np.ones(max(len(places) - 1, 0), bool)
    alive = np.flatnonzero(same)
    for at in [*range(0, width - 8, 8), width - 8]:
        left, right = (words[p[alive] + at].view(np.uint64).ravel() for p in (places[:-1], places[1:]))
        same[alive[left != right]] = False
        alive = alive[left == right]
    return same


def repeated_in_block(strings: list[bytes], weights: list[int], width: int) -> Iterator[tuple[int, int, int]]:
    """(string, low, high): runs of windows of the strings that occur twice, counting a string of weight n as n strings."""
    lengths = np.array([len(s) for s in strings])
    starts = np.cumsum(np.concatenate([[0], lengths[:-1] + 1]))  # a separator after each string
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    symbols = data.astype(np.int64) + 2
    symbols[starts + lengths] = 1
    ranks = suffix_ranks(symbols)
    windows = np.concatenate([np.arange(s, s + n - width + 1) for s, n in zip(starts, lengths)])
    owner = np.repeat(np.arange(len(strings)), lengths - width + 1)
    repeated = np.array(weights)[owner] > 1
    order = np.argsort(ranks[windows])
    same = equal_neighbours(data, windows[order], width)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    place = windows - starts[owner]
    hit = np.flatnonzero(repeated)
    if len(hit):
        breaks = np.flatnonzero((np.diff(hit) != 1) | (np.diff(owner[hit]) != 0)) + 1
        for low, high in zip(np.append(0, breaks), np.append(breaks, len(hit))):
            yield int(owner[hit[low]]), int(place[hit[low]]), int(place[hit[high - 1]])


def suffix_dedup(docs: DataFrame, window: int = 200, anchor: int = 64) -> DataFrame:
    """(doc_id, n_units, n_removed, n_spans, kept_sha256): each row of docs without the bytes of repeated strings of window bytes.

    A byte goes if a string of that length over it starts elsewhere too, in this document or another. repeats.py narrows
    the corpus down to stretches whose anchor is shared by different stretches; equal windows lie in stretches with one
    anchor, so these are dealt to workers by anchor, and every worker sorts the suffixes of its stretches by the
    difference-cover algorithm, in blocks of bounded size, and compares the neighbouring prefixes of window bytes. One
    anchor whose stretches are larger than GROUP bytes isn't gathered in a task: its windows are counted by hash, with
    partial sums.

    A null or empty text has no bytes; null doc_ids and repeated rows stay, and the latter are each other's copies; an
    empty table gives an empty result; other columns are ignored.
    """
    unit = Unit(False, window, anchor)
    kinds = "content long, weight long, anchor long, data binary"

    def stretches(parts: bytes, symbols: np.ndarray, wanted: list[tuple]) -> list[pa.Array]:
        columns = [[w[0] for w in wanted], [w[1] for w in wanted], [w[2] for w in wanted], [parts[w[4] : w[5] + window] for w in wanted]]
        return [pa.array(c, pa.binary() if k == 3 else pa.int64()) for k, c in enumerate(columns)]

    def sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor; a block ends with a whole group."""
        contents, weights, strings, size, last = [], [], [], 0, None

        def done() -> pa.RecordBatch:
            found = [(contents[k], low, high) for k, low, high in repeated_in_block(strings, weights, window)]
            return pa.record_batch([pa.array([x[c] for x in found], pa.int64()) for c in range(3)], ["content", "low", "high"])

        for batch in batches:
            for content, weight, group, data in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= BLOCK and group != last:
                    yield done()
                    contents, weights, strings, size = [], [], [], 0
                contents.append(content)
                weights.append(weight)
                strings.append(data)
                size, last = size + len(data) + 1, group
        if strings:
            yield done()

    def windows(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks = [np.zeros((0, 4), np.int64)]
        for content, weight, data in zip(*(c.to_pylist() for c in batch.columns)):
            hashes = rolling(unit.symbols(data), window).view(np.int64)
            blocks.append(np.stack([np.full(len(hashes), content), np.arange(len(hashes)), hashes, np.full(len(hashes), weight)], axis=1))
        return pa.record_batch([pa.array(c) for c in np.concatenate(blocks).T.copy()], ["content", "place", "edge", "weight"])

    def resolve(texts: DataFrame, segments: DataFrame) -> DataFrame:
        rows = cut(mixed_contents(texts, segments, unit, stretches, kinds))
        sizes = rows.groupBy("anchor").agg(F.sum(F.length("data") + 1).alias("size"))
        large = cut(sizes.where(F.col("size") > GROUP).select("anchor"))
        small = rows.join(large, "anchor", "left_anti").select("content", "weight", "anchor", "data")
        # dealt by a hash of the anchor: an exchange by the anchor itself is left out as the join's own will do, which AQE may turn into a local read
        sorted_runs = small.repartition(F.xxhash64("anchor")).sortWithinPartitions("anchor").mapInArrow(sort_blocks, "content long, low long, high long")
        counted = by_batch(rows.join(large, "anchor", "left_semi").select("content", "weight", "data"), windows, "content long, place long, edge long, weight long")
        twice = cut(counted.groupBy("edge").agg(F.sum("weight").alias("n")).where("n >= 2").select("edge"))
        places = counted.join(twice, "edge").groupBy("content").agg(F.array_sort(F.collect_list("place")).alias("places"))
        counted_runs = places.select("content", F.explode(consecutive_runs(F.col("places"))).alias("r")).select("content", "r.low", "r.high")
        return repeated_runs(sorted_runs.unionByName(counted_runs))

    return remove_repeats(docs, unit, resolve)
