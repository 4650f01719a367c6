"""Benchmark decontamination: document windows that nearly repeat a benchmark item."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import by_batch, raw_texts, rolling, word_hashes
from eventloom.llm.simhash import hamming_ball

#: Bytes of benchmark text that one pass over the documents looks for; a larger benchmark is taken in blocks of about this
#: size. A block becomes some ten times as many bytes of arrays.
BYTES_A_PASS = 32 << 20
#: Windows whose bits are summed at once, and candidates that are compared at once: they bound the memory of a very long text.
WINDOWS_AT_ONCE, CANDIDATES_AT_ONCE = 1 << 14, 1 << 20
BLOCKS, BLOCK_BITS = 8, 8


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)


def _prints(ones: np.ndarray, size: int) -> np.ndarray:
    return np.packbits(2 * ones > size, axis=1).view(np.uint64)[:, 0]


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... count[0] of them, then those of first[1] and so on."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(first, count)


def _members(found: np.ndarray, at: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Those of the places at whose value stands in the sorted vocabulary."""
    values = found[at]
    return at[vocabulary[np.minimum(np.searchsorted(vocabulary, values), len(vocabulary) - 1)] == values]


class HammingIndex:
    """Multi-index of 64-bit fingerprints: for each block of 8 bits and each of its values, the list of fingerprints whose
    own block lies in the Hamming ball around the value. Fingerprints within radius have such a block in common, as
    radius // 8 differing bits at most fall on one of eight. The lists stand end to end in one array a block."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        ball = np.array(hamming_ball(BLOCK_BITS, radius // BLOCKS), np.uint8)
        self.first, self.members = [], []
        for block in prints.view(np.uint8).reshape(-1, BLOCKS).T:
            keys = (block[:, None] ^ ball).ravel()
            order = np.argsort(keys, kind="stable")
            self.first.append(np.searchsorted(keys[order], np.arange(257)))
            self.members.append((order // len(ball)).astype(np.int32))

    def near(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in prints, member, differing bits) of all pairs within the radius; a portion of the candidates at a time."""
        blocks = prints.view(np.uint8).reshape(-1, BLOCKS)
        fetched = np.stack([first[blocks[:, b].astype(np.int64) + 1] - first[blocks[:, b]] for b, first in enumerate(self.first)])
        portion = np.cumsum(fetched.sum(axis=0)) // CANDIDATES_AT_ONCE
        for at in np.split(np.arange(len(prints)), np.flatnonzero(np.diff(portion)) + 1):
            found = []
            for b, (first, members) in enumerate(zip(self.first, self.members)):
                begin, count = first[blocks[at, b]], fetched[b, at]
                left, right = np.repeat(at, count), members[_spread(begin, count)]
                close = np.bitwise_count(prints[left] ^ self.prints[right]) <= self.radius
                found.append(left[close] * len(self.prints) + right[close])
            pairs = np.unique(np.concatenate(found))
            left, right = pairs // len(self.prints), pairs % len(self.prints)
            yield left, right, np.bitwise_count(prints[left] ^ self.prints[right])


@dataclass(frozen=True)
class Length:
    """Items of one length in words: their places in the benchmark, their different shingles, sorted, and their index."""

    words: int
    members: np.ndarray
    vocabulary: np.ndarray
    index: HammingIndex


class Benchmark:
    """Items, their shingles, and for each item length the fingerprints in a multi-index."""

    def __init__(self, items: list[tuple[int, bytes]], shingle: int, radius: int, threshold: float):
        self.threshold, self.ids, shingles, words = threshold, [], [], []
        for item_id, text in sorted(items, key=lambda x: (x[0] is None, x[0], x[1])):
            split = text.lower().split()
            if split:
                self.ids.append(item_id)
                words.append(len(split))
                shingles.append(rolling(word_hashes(split), min(shingle, len(split))))
        self.shingles = shingles
        prints = np.array([_prints(_bits(s).sum(axis=0, dtype=np.int64)[None], len(s))[0] for s in shingles], np.uint64)
        self.lengths: dict[int, list[Length]] = {}  # by shingle width
        for n in sorted(set(words)):
            members = np.array([k for k, x in enumerate(words) if x == n])
            vocabulary = np.unique(np.concatenate([shingles[k] for k in members]))
            self.lengths.setdefault(min(shingle, n), []).append(Length(n, members, vocabulary, HammingIndex(prints[members], radius)))
        # by shingle width: all shingles, a bitmap before them, and the fewest that any item needs
        self.known: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        for width, lengths in self.lengths.items():
            every, seen = np.unique(np.concatenate([x.vocabulary for x in lengths])), np.zeros(1 << 20, bool)
            seen[(every >> np.uint64(44)).astype(np.int64)] = True
            self.known[width] = every, seen, min(self._need(x.words - width + 1) for x in lengths)

    def _need(self, size: int) -> int:
        """Shingles that two windows of so many have in common if they are similar enough."""
        return int(np.ceil(2 * self.threshold / (1 + self.threshold) * size - 1e-9))

    def matches(self, text: bytes) -> Iterator[tuple[int, int, float, int]]:
        """(item, first word, similarity, differing bits) of the best window for each item that the text repeats.

        Two windows of n shingles each with a weighted similarity of threshold have 2 * threshold / (1 + threshold) * n
        shingles in common. So only windows in which so many are any shingles of items of that length are fingerprinted.
        The others can't match, whatever the item; which items a window is held against is for the index to tell.
        """
        hashes = word_hashes(text.lower().split())
        best: dict[int, tuple[float, int, int]] = {}
        for width, lengths in self.lengths.items():
            found = rolling(hashes, width)
            every, seen, fewest = self.known[width]
            some = _members(found, np.flatnonzero(seen[(found >> np.uint64(44)).astype(np.int64)]), every)
            if len(some) < fewest:
                continue
            for x in lengths:
                size = x.words - width + 1
                need = self._need(size)
                if len(found) < size or len(some) < need:
                    continue
                hits = _members(found, some, x.vocabulary)
                if len(hits) >= need:
                    self._windows(found, hits, size, need, x, best)
        for k, (similarity, start, bits) in sorted(best.items()):
            yield k, -start, similarity, -bits

    def _windows(self, found: np.ndarray, hits: np.ndarray, size: int, need: int, x: Length, best: dict) -> None:
        # the windows with at least need hits: those that begin in (last of some need hits - size, first of them]
        first, last = hits[: len(hits) - need + 1], hits[need - 1 :]
        tight = last - first < size
        low, high = np.maximum(last[tight] - size + 1, 0), np.minimum(first[tight], len(found) - size)
        edges = np.zeros(len(found) + 1, np.int32)
        some = low <= high
        np.add.at(edges, low[some], 1)
        np.add.at(edges, high[some] + 1, -1)
        starts = np.flatnonzero(np.cumsum(edges))
        gaps = np.flatnonzero(np.diff(starts) > size) + 1
        for near in np.split(starts, np.union1d(gaps, np.arange(WINDOWS_AT_ONCE, len(starts), WINDOWS_AT_ONCE))):
            if not len(near):
                continue
            begin, end = int(near[0]), int(near[-1]) + size
            sums = np.zeros((end - begin + 1, 64), np.int64)
            np.cumsum(_bits(found[begin:end]), axis=0, out=sums[1:])
            for left, right, bits in x.index.near(_prints(sums[near - begin + size] - sums[near - begin], size)):
                counts: dict[int, Counter] = {}
                for i, j, differ in zip(left.tolist(), right.tolist(), bits.tolist()):
                    k, start = int(x.members[j]), int(near[i])
                    if j not in counts:
                        counts[j] = Counter(self.shingles[k].tolist())
                    shared = (Counter(found[start : start + size].tolist()) & counts[j]).total()
                    similarity = shared / (2 * size - shared)
                    if similarity >= self.threshold:
                        best[k] = max(best.get(k, (0.0, 0, 0)), (similarity, -start, -differ))


def _passes(items: DataFrame, shingle: int, radius: int, threshold: float) -> Iterator[Benchmark]:
    """The benchmark in blocks of about BYTES_A_PASS bytes of text, by hash; only one block is in memory at a time."""
    items = items.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-max(size, 1) // BYTES_A_PASS)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield Benchmark([(r.item_id, r.text.encode()) for r in rows], shingle, radius, threshold)


def contaminated(docs: DataFrame, items: DataFrame, shingle: int = 5, radius: int = 20, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, start_word, similarity, bits): each benchmark item that a document repeats, at its best window.

    Words are what stands between ASCII white space, A-Z in lower case. A window has as many words as the item; its
    64-bit SimHash over shingles must differ from the item's in at most radius bits, which the multi-index finds without
    loss, and the weighted Jaccard similarity of their shingles, repeats counted, must reach threshold. An item
    of fewer than shingle words is one shingle. Whole texts are searched; nothing is shuffled.

    Null or empty texts and items match nothing; a null doc_id stays null; repeated rows and items are each reported; an
    empty table gives an empty result; other columns are ignored.
    """
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("start_word", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("bits", T.LongType())])

    def kernel(benchmark: Benchmark) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [(i, benchmark.ids[k], start, s, bits) for i, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))) for k, start, s, bits in benchmark.matches(text)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            return pa.record_batch([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], out.names)

        return run

    wanted = docs.select(F.col("doc_id").cast("long"), "text")
    found = None
    for benchmark in _passes(items, shingle, radius, threshold):
        part = by_batch(wanted, kernel(benchmark), out)
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame, shingle: int = 5, radius: int = 20, threshold: float = 0.8) -> DataFrame:
    """docs without the rows whose text repeats a benchmark item as contaminated() finds it; all columns, no shuffle.

    A null or empty text stays, as do null doc_ids and repeated rows alike; null or empty items match nothing; without
    items all rows stay, and an empty table stays empty; no other column is read.
    """
    at = docs.columns.index("text")

    def kernel(benchmark: Benchmark) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        return lambda batch: batch.filter(pa.array([next(benchmark.matches(x), None) is None for x in raw_texts(batch.column(at))], pa.bool_()))

    for benchmark in _passes(items, shingle, radius, threshold):
        docs = by_batch(docs, kernel(benchmark), docs.schema)
    return docs
