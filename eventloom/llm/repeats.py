"""Windows that a corpus holds at least twice: the frame that substring and suffix-array deduplication share.

1. Every text is cut into segments, runs of windows with one anchor (winnow.py). Equal windows have equal anchors, so a
   segment whose anchor is nowhere else has no repeated window. Nearly all of the corpus ends here.
2. If all segments with an anchor are alike, their windows are all repeated, and no others can equal them.
3. Segments with one anchor but different contents are resolved by the operator's own method, each content once.
4. Each text, with what was found for its segments, is read again and cut.

Texts are named by a hash; copies share one name. Only hashes are shuffled in 1 and 2. The texts that are shuffled in 3
and 4 are those with repeats (a filter of fixed size drops the others before the shuffle). An anchor that a third of all
documents hold is counted with partial sums, and joined by sort-merge joins whose large partitions Spark splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import by_batch, cut, raw_texts, word_hashes
from eventloom.llm.winnow import Segments, anchored_segments, contents

#: Symbols of a text that are cut into segments at once.
STRETCH = 1 << 22
FILTER_BITS = 25


@dataclass(frozen=True)
class Unit:
    """What windows are made of, bytes or words; window and run (of an anchor) count them."""

    words: bool
    window: int
    run: int

    def split(self, text: bytes) -> list[bytes] | bytes:
        return text.split() if self.words else text

    def symbols(self, parts: list[bytes] | bytes) -> np.ndarray:
        return word_hashes(parts) if self.words else np.frombuffer(parts, np.uint8).astype(np.uint64) + np.uint64(1)

    def segments(self, symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray, Segments, np.ndarray]]:
        """(offset, symbols, segments, contents) of each stretch of a text; stretches overlap so that each window is in exactly one."""
        for at in range(0, max(1, len(symbols) - self.window + 1), STRETCH):
            part = symbols[at : at + STRETCH + self.window - 1]
            found = anchored_segments(part, self.window, self.run)
            yield at, part, found, contents(part, found, self.window)

    def digest(self, parts: list[bytes] | bytes, removed: np.ndarray) -> str:
        if self.words:
            return hashlib.sha256(b" ".join(w for w, gone in zip(parts, removed.tolist()) if not gone)).hexdigest()
        return hashlib.sha256(np.frombuffer(parts, np.uint8)[~removed].tobytes()).hexdigest()


def named_texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("page"))


def profiles(texts: DataFrame, unit: Unit) -> DataFrame:
    """(page, anchors, contents, counts): the different segments of each row of texts."""

    def profile(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pairs = [np.stack([s.anchor, c], axis=1) for _, _, s, c in unit.segments(unit.symbols(unit.split(text)))]
        pairs = np.concatenate(pairs)
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        pairs = pairs[order]
        new = np.flatnonzero(np.append(True, (np.diff(pairs, axis=0) != 0).any(axis=1))) if len(pairs) else np.zeros(0, np.int64)
        return pairs[new, 0].view(np.int64), pairs[new, 1].view(np.int64), np.diff(np.append(new, len(pairs)))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [profile(x) for x in raw_texts(batch.column(1))]
        ends = pa.array(np.cumsum([0, *[len(x[0]) for x in found]]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64), pa.int64())) for k in range(3)]
        return pa.record_batch([batch.column(0), *lists], ["page", "anchors", "contents", "counts"])

    return by_batch(texts.select("page", "text"), kernel, "page long, anchors array<long>, contents array<long>, counts array<long>")


def repeated_segments(texts: DataFrame, unit: Unit) -> DataFrame:
    """(page, anchor, content, n, mixed): the segments whose anchor occurs at least twice."""
    rows = cut(profiles(texts, unit)).select("page", F.explode(F.arrays_zip("anchors", "contents", "counts")).alias("s")).select("page", F.col("s.anchors").alias("anchor"), F.col("s.contents").alias("content"), F.col("s.counts").alias("n"))
    groups = rows.groupBy("anchor").agg(F.sum("n").alias("all"), F.min("content").alias("low"), F.max("content").alias("high")).where(F.col("all") >= 2)
    shared = cut(groups.select("anchor", (F.col("low") != F.col("high")).alias("mixed")))  # a join of plain exchanges can be split where an anchor is frequent
    return cut(rows.join(shared, "anchor").select("page", "anchor", "content", "n", "mixed"))


class PageFilter:
    """A set of pages in a bitmap of fixed size: it may hold more than it was given, so it only saves shuffling."""

    def __init__(self, pages: DataFrame):
        place = F.pmod("page", F.lit(1 << FILTER_BITS))
        rows = pages.groupBy(F.shiftright(place, 15).alias("bucket")).agg(F.bitmap_construct_agg(place % 32768).alias("bits")).collect()
        self.bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        for r in rows:
            self.bits[r.bucket * 4096 : (r.bucket + 1) * 4096] = np.frombuffer(r.bits, np.uint8)

    def __call__(self, pages: np.ndarray) -> np.ndarray:
        place = pages & ((1 << FILTER_BITS) - 1)
        return self.bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1

    def keep(self, texts: DataFrame) -> DataFrame:
        at = texts.columns.index("page")
        return by_batch(texts, lambda batch: batch.filter(pa.array(self(batch.column(at).to_numpy(zero_copy_only=False)))), texts.schema)


def mixed_contents(texts: DataFrame, segments: DataFrame, unit: Unit, kernel: Callable, schema: str) -> DataFrame:
    """kernel's rows for each different content that shares its anchor with others.

    kernel gets (parts, symbols, wanted), wanted being (content, weight, anchor, place, first, last) for each content that
    this text was chosen to show, and returns columns for schema. weight is how often the corpus holds the content.
    """
    chosen = segments.where("mixed").groupBy("content").agg(F.sum("n").alias("weight"), F.min("page").alias("page"))
    of_page = chosen.groupBy("page").agg(F.collect_list(F.struct("content", "weight")).alias("wanted"))
    shown = PageFilter(of_page).keep(texts.select("page", "text")).groupBy("page").agg(F.first("text").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = None
        for text, wanted in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist()):
            weights = {w["content"]: w["weight"] for w in wanted}
            parts = unit.split(text)
            symbols, found = unit.symbols(parts), []
            for at, _, s, c in unit.segments(symbols):
                for k, content in enumerate(c.view(np.int64).tolist()):
                    if content in weights:
                        found.append((content, weights.pop(content), int(s.anchor[k].view(np.int64)), int(s.place[k]) + at, int(s.first[k]) + at, int(s.last[k]) + at))
            new = kernel(parts, symbols, found)
            columns = [[x] for x in new] if columns is None else [[*old, x] for old, x in zip(columns, new)]
        empty = pa.array([], pa.int64())
        names = [x.split()[0] for x in schema.split(", ")]
        return pa.record_batch([pa.chunked_array(c).combine_chunks() if len(c) else empty for c in columns], names) if columns else None

    return by_batch(shown.join(of_page, "page").select("text", "wanted"), run, schema)


def edges(unit: Unit) -> tuple[Callable, str]:
    """Kernel for mixed_contents: a row for each window of a content, with its hash and those of the windows before and after it in the content (0: none)."""
    from eventloom.llm.common import rolling

    def kernel(parts: list[bytes] | bytes, symbols: np.ndarray, wanted: list[tuple]) -> list[pa.Array]:
        blocks = [np.zeros((0, 6), np.int64)]
        for content, weight, _, _, first, last in wanted:
            hashes = rolling(symbols[first : last + unit.window], unit.window).view(np.int64)
            hashes = np.where(hashes == 0, 1, hashes)
            padded = np.concatenate([[0], hashes, [0]])
            n = len(hashes)
            blocks.append(np.stack([np.full(n, content), np.arange(n), hashes, padded[2:], padded[:-2], np.full(n, weight)], axis=1))
        return [pa.array(c) for c in np.concatenate(blocks).T.copy()]

    return kernel, "content long, place long, edge long, next long, before long, weight long"


def consecutive_runs(places: Column) -> Column:
    """The runs (low, high) of consecutive numbers in a sorted array of different ones."""
    lows, highs = (F.array_except(places, F.transform(places, lambda x: x + step)) for step in (1, -1))
    return F.zip_with(lows, highs, lambda low, high: F.struct(low.alias("low"), high.alias("high")))


def repeated_runs(flags: DataFrame) -> DataFrame:
    """(content, runs): for each content of flags(content, low, high) the runs of windows that are repeated."""
    return flags.groupBy("content").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("runs"))


def remove_repeats(docs: DataFrame, unit: Unit, resolve: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """(doc_id, n_units, n_removed, n_spans, kept_sha256) for each row of docs(doc_id, text), every unit gone that lies in a window which starts elsewhere too.

    resolve(texts, segments) gives (content, runs) for the mixed segments.
    """
    texts = named_texts(docs)
    segments = repeated_segments(texts, unit)
    runs = cut(resolve(texts, segments))
    whole = segments.where("not mixed").groupBy("page").agg(F.collect_set("anchor").alias("anchors"))
    partly = segments.where("mixed").select("page", "content").distinct().join(runs, "content").groupBy("page").agg(F.collect_list(F.struct("content", "runs")).alias("parts"))
    found = cut(whole.join(partly, "page", "full_outer"))
    pages = PageFilter(found)

    def shorten(text: bytes, anchors: list[int], found: list[dict]) -> tuple[int, int, int, str]:
        parts = unit.split(text)
        edge = np.zeros(len(parts) + 1, np.int64)
        if anchors or found:
            known, of_content = np.array(sorted(anchors or []), np.int64), {p["content"]: p["runs"] for p in found or []}
            for at, _, s, c in unit.segments(unit.symbols(parts)):
                hit = np.isin(s.anchor.view(np.int64), known)
                np.add.at(edge, s.first[hit] + at, 1)
                np.add.at(edge, s.last[hit] + at + unit.window, -1)
                if of_content:
                    for k in np.flatnonzero(~hit).tolist():
                        for r in of_content.get(int(c[k].view(np.int64)), ()):
                            edge[s.first[k] + at + r["low"]] += 1
                            edge[s.first[k] + at + r["high"] + unit.window] -= 1
        removed = np.cumsum(edge[:-1]) > 0
        spans = int((np.diff(removed.astype(np.int8), prepend=0) == 1).sum())
        return len(parts), int(removed.sum()), spans, unit.digest(parts, removed)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = ["doc_id", "n_units", "n_removed", "n_spans", "kept_sha256"]

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        given = batch.columns[2:]
        lists = ([c[k].as_py() for c in given] if given else [None, None] for k in range(len(batch)))  # a row's at a time
        out = [shorten(text, *x) for text, x in zip(raw_texts(batch.column(1)), lists)]
        return pa.record_batch([batch.column(0), *[pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]], names)

    schema = "doc_id long, n_units long, n_removed long, n_spans long, kept_sha256 string"

    def without(batch: pa.RecordBatch) -> pa.RecordBatch:
        return kernel(batch.filter(pa.array(~pages(batch.column(2).to_numpy(zero_copy_only=False)))).select(["doc_id", "text"]))

    untouched = by_batch(texts, without, schema)
    touched = by_batch(pages.keep(texts).join(found, "page", "left").select("doc_id", "text", "anchors", "parts"), kernel, schema)
    return untouched.unionByName(touched)
