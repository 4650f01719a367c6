"""Harmonic packing of tokenised documents into fixed-length training sequences."""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.types as T
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import cut, give_back, leftovers, raw_texts

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Words of a generation whose ids a worker remembers. A full generation is kept until the next one is full, and words met
#: again move over to that, so frequent ones stay. Results don't depend on it.
REMEMBERED_WORDS = 400_000
#: Bytes of text that are tokenised at once; a longer text is tokenised by itself.
BYTES_AT_ONCE = 4 << 20
#: Different words that are encoded at once.
WORDS_AT_ONCE = 256
#: Words of lower-case ASCII and Latin-1 letters, in UTF-8. They are composed, and one piece each, under these steps.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
STEPS = [
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
]


def _little_endian(ids: list[int]) -> bytes:
    out = array("I", ids)  # four bytes each
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _plain(tokenizer: Tokenizer) -> tuple[Tokenizer | None, np.ndarray]:
    """The same model without the steps that leave PLAIN words as they are, and which of its ids end a word; None if the
    tokenizer has other steps, added tokens within PLAIN words, or ids that don't tell where a word ends."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    steps = [json.loads(x.__getstate__()) for x in (tokenizer.normalizer, tokenizer.pre_tokenizer) if x is not None]
    model = tokenizer.model
    added = any(PLAIN.fullmatch(t.content.lower().encode()) for t in tokenizer.get_added_tokens_decoder().values())
    if steps != STEPS or added or not isinstance(model, models.BPE) or not model.end_of_word_suffix or model.dropout:
        return None, np.zeros(0, bool)
    plain = Tokenizer(model)
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for t, i in vocabulary.items() if t.endswith(model.end_of_word_suffix)]] = True
    return plain, ends


class WordTokenizer:
    """Ids of a text by a tokenizer that lower-cases, drops white space and keeps letters, digits and marks apart, as
    little-endian unsigned 32-bit integers.

    Such a tokenizer treats the stretches between ASCII white space one by one, so the ids of a text are those of its
    stretches in order, and each different stretch is encoded once. Lower case A-Z and the marks that follow a last
    letter or digit are taken off first, as that leaves fewer different stretches; a text that may hold the
    tokenizer's special strings, which are case-sensitive, keeps its case. Texts are split, and their ids joined, in
    columns: Python meets each different stretch of a call once, however often it stands there.
    """

    def __init__(self, path: str):
        self.remembered = REMEMBERED_WORDS
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = min((t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()), default=None)
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.plain, self.ends = _plain(self.tokenizer)

    def forget(self) -> None:
        """Lets go of all remembered words."""
        self.known, self.old = {}, {}

    def _unknown(self, words: Iterable[bytes]) -> list[bytes]:
        """The words that are in neither generation; those of the old one move over."""
        out = []
        for w in words:
            if w not in self.known:
                if w in self.old:
                    self.known[w] = self.old[w]
                else:
                    out.append(w)
        return out

    def _encode_plain(self, words: list[bytes]) -> None:
        """Encodes words as one text. Each is one piece of it, and the last id of a piece is one that ends a word."""
        ids = np.array(self.plain.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == len(words) and ends[-1] == len(ids):
            raw = ids.tobytes()
            self.known.update(zip(words, [raw[4 * i : 4 * k] for i, k in pairwise([0, *ends.tolist()])]))

    def _encode(self, words: set[bytes]) -> None:
        new = self._unknown(words)
        if self.plain:
            plain = [w for w in new if PLAIN.fullmatch(w)]
            for at in range(0, len(plain), WORDS_AT_ONCE):
                self._encode_plain(plain[at : at + WORDS_AT_ONCE])
            new = [w for w in new if w not in self.known]
        for at in range(0, len(new), WORDS_AT_ONCE):
            some = new[at : at + WORDS_AT_ONCE]
            for w, e in zip(some, self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)):
                self.known[w] = _little_endian(e.ids)

    def learn(self, words: Iterable[bytes]) -> None:
        split = {}
        for w in self._unknown(words):
            stem = w.rstrip(b".,!?;:")
            split[w] = (stem, w[len(stem) :]) if len(stem) < len(w) and stem[-1:].isalnum() else (w, b"")
        self._encode({x for pair in split.values() for x in pair})
        for w, (stem, marks) in split.items():
            if marks:
                self.known[w] = self.known[stem] + self.known[marks]

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        if len(self.known) > self.remembered:
            self.known, self.old = {}, self.known
        column = pa.array(texts, pa.large_string())
        lower = pc.ascii_lower(column)  # A-Z alone
        if self.special:
            lower = pc.if_else(pc.match_substring(column, self.special), column, lower)
        split = pc.ascii_split_whitespace(lower)  # white space at an end leaves an empty word there
        coded = split.values.cast(pa.large_binary()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.learn(words)
        joined = pa.array(map(self.known.__getitem__, words), pa.large_binary()).take(coded.indices)
        ids, ends = joined.buffers()[2], np.frombuffer(joined.buffers()[1], np.int64)[split.offsets.to_numpy()]
        column = lower = split = coded = words = joined = None
        for start, end in pairwise(ends.tolist()):
            yield ids[start:end].to_pybytes()


@lru_cache
def tokenizer(path: str) -> WordTokenizer:
    """One a worker, whose words last from task to task until the worker gets other work."""
    made = WordTokenizer(path)
    leftovers.append(made.forget)
    return made


def slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Successive rows of (doc_id, text) whose texts have at most so many bytes, or one row."""
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(), dtype=np.int64), 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, end - at)
        at = end


@lru_cache(maxsize=1 << 16)
def pieces(n: int, capacity: int, tail: int) -> tuple[int, ...]:
    """Lengths into which n tokens are cut: each is a class length capacity // j, but for a last one of at most tail.

    The largest class length that fits is cut off again and again; what remains shrinks faster than geometrically, so
    few cuts are needed.
    """
    out = []
    while n > tail:
        j = -(-capacity // n)
        while capacity // j > n:
            j += 1
        out.append(capacity // j)
        n -= out[-1]
    return (*out, n) if n else tuple(out)


def tokenised_pieces(docs: DataFrame, path: str, end_id: int, capacity: int, tail: int, remembered: int = REMEMBERED_WORDS, at_once: int = BYTES_AT_ONCE) -> DataFrame:
    """Pieces of each document, with the partition that made them and their number among its pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, part = tokenizer(path), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        encode.remembered, counts = remembered, {}
        for batch in (x for b in batches for x in slices(b, at_once)):
            ids, rows = batch.column(0), []
            for k, text in enumerate(encode(raw_texts(batch.column(1)))):
                tokens, start = memoryview(text + end), 0
                for length in pieces(len(tokens) // 4, capacity, tail):
                    idx = counts[length] = counts.get(length, -1) + 1
                    rows.append((k, start, length, zlib.crc32(tokens[4 * start : 4 * (start + length)]), len(tokens) // 4, idx))
                    start += length
            if rows:
                k, *columns = (np.array(x, np.int64) for x in zip(*rows))
                yield pa.record_batch([ids.take(pa.array(k)), *map(pa.array, columns), pa.array(np.full(len(k), part, np.int64))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "idx", "part"])
            pa.default_memory_pool().release_unused()  # of a slice's columns
        give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, idx long, part long")


def harmonic_pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 2048, tail: int = 32, remembered: int = REMEMBERED_WORDS, at_once: int = BYTES_AT_ONCE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids, end_id last, are cut into pieces of the reciprocal lengths capacity // j and a rest of at most
    tail. All pieces of a class have one length, so a bin of a class takes the same number of pieces, capacity // length,
    and is full, or short by less than 1 / (j + 1) of it where capacity isn't a multiple. Pieces are numbered within
    their class by the partition that made them plus the pieces of earlier partitions, so that bins are filled without
    moving pieces to one worker. Of each class less than one bin of pieces is left over: with at most capacity / 2 + tail
    classes and fewer than capacity // length pieces in each, those are bounded whatever the input's size, and are packed
    together, longest first, each into the first sequence with room.

    A worker remembers the ids of up to twice remembered words, and takes at_once bytes of texts, or one text, at a time:
    less of both takes less memory and more time, to the same result.

    A null or empty text is the end id alone; a null doc_id stays null; repeated rows are packed once each; an empty
    table gives an empty result; other columns are ignored.
    """
    made = cut(tokenised_pieces(docs, path, end_id, capacity, tail, remembered, at_once))
    counts = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    per_bin = F.floor(F.lit(capacity) / F.col("length"))
    totals = counts.groupBy("length").agg(F.sum("n").alias("total")).withColumn("bins", F.floor(F.col("total") / per_bin))
    ordered = Window.orderBy(F.desc("length"))  # of the classes: at most capacity / 2 + tail rows
    classes = totals.select("length", "bins", (F.sum("bins").over(ordered) - F.col("bins")).alias("first_bin"), F.sum("bins").over(Window.partitionBy()).alias("all_bins"))
    numbered = made.join(bases.join(classes, "length"), ["length", "part"]).withColumn("rank", F.col("base") + F.col("idx"))
    placed = numbered.withColumn("bin", F.floor(F.col("rank") / per_bin))
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = placed.where("bin < bins").select(*keep, (F.col("first_bin") + F.col("bin")).alias("sequence_id"), (F.col("rank") % per_bin * F.col("length")).alias("offset"))
    rest = placed.where("bin >= bins").select(*keep, "all_bins", "rank")

    def first_fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "rank"], ascending=[False, True], ignore_index=True)
        used: list[int] = []
        first = 0  # sequences before it have no room even for the shortest piece
        shortest = int(rows["length"].min())
        where, at = [], []
        for length in rows["length"]:
            while first < len(used) and used[first] + shortest > capacity:
                first += 1
            k = next((k for k in range(first, len(used)) if used[k] + length <= capacity), len(used))
            if k == len(used):
                used.append(0)
            where.append(k)
            at.append(used[k])
            used[k] += length
        return rows[keep].assign(sequence_id=rows["all_bins"] + where, offset=at)

    out = T.StructType([T.StructField(c, T.LongType()) for c in (*keep, "sequence_id", "offset")])
    return full.unionByName(rest.groupBy("all_bins").applyInPandas(first_fit, out))
