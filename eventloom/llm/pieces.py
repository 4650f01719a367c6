"""SentencePiece BPE encoding in vectorised merge rounds, and decoding."""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.types as T
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import forget_leftovers, give_back, raw_texts

SPACE = "▁"
#: Bytes of text that are encoded at once; a longer text is encoded by itself.
BYTES_AT_ONCE = 4 << 20
#: Words of more symbols are merged by a queue: rounds would go over all of them for each merge that has to wait for another.
LONG_WORD = 1 << 14
NEVER = np.iinfo(np.int32).max

codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


class PieceModel:
    """Encoder and decoder of a BPE model with byte fallback, to the same ids and texts as the sentencepiece library gives.

    The library's part is to read the model and to normalise texts. A normalised text is cut between characters that no
    piece holds side by side, as no merge goes across such a cut. What lies between are words; each different one of a
    call is encoded once.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=path)
        self.size = n = lib.vocab_size()
        names = lib.id_to_piece(list(range(n)))
        is_byte, is_control, is_unknown, is_unused = (np.array(f(list(range(n)))) for f in (lib.is_byte, lib.is_control, lib.is_unknown, lib.is_unused))
        if is_byte.sum() != 256 or is_unused.any():
            raise ValueError("only models with byte fallback and without unused pieces")
        normal = np.flatnonzero(~(is_byte | is_control | is_unknown)).tolist()
        score = np.array(lib.get_score(list(range(n))))
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)  # higher scores merge first, equal ones from left to right
        symbols = {names[i]: i for i in normal}
        chars = sorted(set("".join(symbols)))
        for c in chars:
            symbols.setdefault(c, len(symbols) + n)  # a part of pieces that is none itself
        self.of_char = np.full(0x110000, -1, np.int32)
        self.of_char[[ord(c) for c in chars]] = [symbols[c] for c in chars]
        self.byte_ids = np.empty(256, np.int32)
        self.byte_ids[[int(names[i][3:5], 16) for i in np.flatnonzero(is_byte)]] = np.flatnonzero(is_byte)
        self._read_pairs([names[i] for i in normal], symbols)
        self._read_bigrams([names[i] for i in normal], chars)
        texts = [b"" if c else b" \xe2\x81\x87 " if u else bytes([int(x[3:5], 16)]) if b else x.replace(SPACE, " ").encode() for x, b, c, u in zip(names, is_byte, is_control, is_unknown)]
        self.texts = pa.array(texts, pa.large_binary())
        self.control = is_control
        self.spaced = np.zeros(n, bool)
        self.spaced[[i for i in normal if names[i].startswith(SPACE)]] = True
        example = int(self.spaced.argmax())
        self.strips = lib.decode([example]) != names[example].replace(SPACE, " ")

    def _read_pairs(self, pieces: list[str], symbols: dict[str, int]) -> None:
        """All pairs of symbols that make a piece, sorted, and the piece."""
        self.base = n = max(symbols.values()) + 1
        pairs = {symbols[x[:i]] * n + symbols[x[i:]]: symbols[x] for x in pieces for i in range(1, len(x)) if x[:i] in symbols and x[i:] in symbols}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.pairs.tolist()], np.int32)

    def _read_bigrams(self, pieces: list[str], chars: list[str]) -> None:
        """Which characters, numbered from 1, stand side by side in a piece; all others have number 0."""
        self.number = np.zeros(0x110000, np.int32)
        self.number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.beside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for x in pieces:
            at = self.number[[ord(c) for c in x]]
            self.beside[at[:-1], at[1:]] = True
        space = self.number[ord(SPACE)]
        self.by_space = not np.delete(self.beside[:, space], space).any()  # no piece goes on with a space

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1."""
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.made[at], -1) if len(self.pairs) else np.full(len(key), -1, np.int32)

    def ranked(self, made: np.ndarray) -> np.ndarray:
        return np.where(made >= 0, self.rank[made], NEVER)

    def merge(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words after all merges, and the places at which they begin. first marks where a word begins.

        In each round every word merges its pair of least rank, at all its places from left to right at once, and the
        arrays are compacted; finished words leave them. The places are merged one after the other where that could
        differ: if a merge makes a pair whose turn would come before the next place's, the places after it wait.
        """
        out, alive = symbols.copy(), np.ones(len(symbols), bool)
        begins = np.flatnonzero(first)
        lengths = np.diff(begins, append=len(symbols))
        for a, n in zip(begins[lengths > LONG_WORD], lengths[lengths > LONG_WORD]):
            self._merge_by_queue(out[a : a + n], alive[a : a + n])
        open_ = (lengths > 1) & (lengths <= LONG_WORD)
        at = np.flatnonzero(np.repeat(open_, lengths))
        s, first = symbols[at], first[at]
        made = self._pairs_within(s, first)
        while len(s):
            begins = np.flatnonzero(first)
            lengths = np.diff(begins, append=len(s))
            rank = self.ranked(made)
            least = np.minimum.reduceat(rank, begins)
            going = np.repeat(least < NEVER, lengths)
            if not going.all():
                out[at[~going]] = s[~going]
                at, s, first, made, rank = (x[going] for x in (at, s, first, made, rank))
                lengths, least = (x[least < NEVER] for x in (lengths, least))
                if not len(s):
                    break
            hit = self._leftmost(np.flatnonzero(rank == np.repeat(least, lengths)))
            hit = self._in_turn(hit, s, first, made, np.repeat(np.arange(len(lengths)), lengths))
            s[hit] = made[hit]
            keep = np.ones(len(s), bool)
            keep[hit + 1] = False
            alive[at[hit + 1]] = False
            moved = hit - np.arange(len(hit))  # every hit before one takes a place out
            at, s, first, made = (x[keep] for x in (at, s, first, made))
            for i in (moved, moved[~first[moved]] - 1):
                inner = i[(i + 1 < len(s))]
                inner = inner[~first[inner + 1]]
                made[i] = -1
                made[inner] = self.merged(s[inner], s[inner + 1])
        return out[alive], np.flatnonzero(alive)

    def _pairs_within(self, s: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The piece that each symbol makes with the next one of its word, or -1."""
        made = np.full(len(s), -1, np.int32)
        inner = np.flatnonzero(~first[1:])
        made[inner] = self.merged(s[inner], s[inner + 1])
        return made

    @staticmethod
    def _leftmost(hit: np.ndarray) -> np.ndarray:
        """Of places side by side every second one, from the left."""
        begins = np.flatnonzero(np.diff(hit, prepend=-2) > 1)
        return hit[(hit - np.repeat(hit[begins], np.diff(begins, append=len(hit)))) % 2 == 0]

    def _in_turn(self, hit: np.ndarray, s: np.ndarray, first: np.ndarray, made: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The places of each word up to the first one whose merge makes a pair that comes before the word's next place."""
        of, piece = word[hit], made[hit]
        several = np.flatnonzero((np.diff(of, prepend=-1) == 0) | (np.diff(of, append=-1) == 0))
        if not len(several):
            return hit
        rank, early = self.rank[piece[several]], np.zeros(len(several), bool)
        here = hit[several]
        inner = np.flatnonzero(~first[here])
        after = several[inner] - 1  # the place before, in case it is two to the left and so merged by then
        joined = (after >= 0) & (hit[after] == here[inner] - 2)
        before = np.where(joined, piece[after], s[here[inner] - 1])
        early[inner] |= self.ranked(self.merged(before, piece[several[inner]])) <= rank[inner]
        inner = np.flatnonzero((here + 2 < len(s)) & ~first[np.minimum(here + 2, len(s) - 1)])
        early[inner] |= self.ranked(self.merged(piece[several[inner]], s[here[inner] + 2])) <= rank[inner]
        if not early.any():
            return hit
        limit = np.full(int(word[-1]) + 1, len(s))
        np.minimum.at(limit, of[several[early]], here[early])
        return hit[hit <= limit[of]]

    def _merge_by_queue(self, s: np.ndarray, alive: np.ndarray) -> None:
        """The same for one word, in place, merge by merge: the next one is taken from a queue."""
        made = self.merged(s[:-1], s[1:])
        at = np.flatnonzero(made >= 0)
        queue = list(zip(self.ranked(made)[at].tolist(), at.tolist(), made[at].tolist(), s[at].tolist(), s[at + 1].tolist()))
        heapify(queue)
        symbol: list[int] = s.tolist()
        before, after = list(range(-1, len(s) - 1)), [*range(1, len(s)), -1]
        pieces = dict(zip(self.pairs.tolist(), self.made.tolist()))

        def push(i: int, k: int) -> None:
            if i >= 0 and k >= 0 and (piece := pieces.get(symbol[i] * self.base + symbol[k], -1)) >= 0:
                heappush(queue, (int(self.rank[piece]), i, piece, symbol[i], symbol[k]))

        while queue:
            _, i, piece, left, right = heappop(queue)
            k = after[i]
            if symbol[i] != left or k < 0 or symbol[k] != right:
                continue  # one of them was merged
            symbol[i], symbol[k], after[i], alive[k] = piece, -2, after[k], False
            if after[i] >= 0:
                before[after[i]] = i
            push(before[i], i)
            push(i, after[i])
        s[:] = symbol

    def _word_ids(self, words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and where each word's begin and end."""
        raw = b"".join(words.to_pylist())
        data = np.frombuffer(raw, np.uint8)
        lead = np.flatnonzero(data & 0xC0 != 0x80)  # first byte of each character
        code = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        begin = np.searchsorted(lead, np.cumsum([0, *pc.binary_length(words).to_pylist()]))  # of each word, in characters
        first = np.ones(len(code), bool)
        number = self.number[code]
        first[1:] = ~self.beside[number[:-1], number[1:]]
        first[begin[:-1]] = True
        symbols, at = self.merge(self.of_char[code], first)
        unknown = (symbols < 0) | (symbols >= self.size)
        counts = np.ones(len(symbols), np.int64)
        counts[unknown] = np.diff(lead, append=len(data))[at[unknown]]
        ends = np.cumsum(counts)
        of = np.repeat(np.arange(len(symbols)), counts)
        ids = symbols[of]
        spelled = np.flatnonzero(unknown[of])
        byte = lead[at[of[spelled]]] + spelled - (ends - counts)[of[spelled]]
        ids[spelled] = self.byte_ids[data[byte]]
        return ids, np.concatenate([[0], ends])[np.searchsorted(at, begin)]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text's begin and end."""
        normal = [self.library.normalize(t.decode()).encode() for t in texts]
        lengths = np.array([len(t) for t in normal], np.int64)
        raw = b"".join(normal)
        data, ends = np.frombuffer(raw, np.uint8), np.cumsum(lengths)
        begins = np.zeros(len(data) + 1, bool)
        if self.by_space:
            mark = np.frombuffer(SPACE.encode(), np.uint8)
            space = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2]))
            begins[space[np.diff(space, prepend=-4) != 3]] = True  # of several spaces the first
        begins[0] = True
        begins[ends] = True  # the end of all texts, too
        cuts = np.flatnonzero(begins)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
        coded = words.dictionary_encode()
        if not len(coded.dictionary):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        ids, of_word = self._word_ids(coded.dictionary)
        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(coded.dictionary), [None, pa.py_buffer(of_word * 4), pa.py_buffer(ids.astype("<i4"))])
        joined = packed.take(coded.indices)
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[: len(cuts)] // 4
        return np.frombuffer(joined.buffers()[2] or b"", "<i4"), offsets[np.searchsorted(cuts, np.concatenate([[0], ends]))]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each stretch of ids between two offsets. An id outside the vocabulary is an error."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < self.size:
            raise ValueError("an id is outside the vocabulary")
        joined = self.texts.take(pa.array(ids))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        raw = memoryview(joined.buffers()[2] or b"")
        seen = np.flatnonzero(~self.control[ids])  # the first id that isn't a control symbol loses its leading space
        at = np.searchsorted(seen, offsets[:-1])
        leader = np.append(seen, len(ids))[at]
        strip = (leader < offsets[1:]) & np.append(self.spaced[ids], False)[leader] & self.strips
        begins, stops, breaks = ends[offsets[:-1]] + strip, ends[offsets[1:]], ends[np.flatnonzero(self.control[ids])]

        def text(a: int, b: int) -> str:  # bytes on both sides of a control symbol don't make a character
            cuts = [a, *breaks[np.searchsorted(breaks, a) : np.searchsorted(breaks, b)].tolist(), b] if len(breaks) else [a, b]
            return "".join(bytes(raw[c:d]).decode(errors="each_byte") for c, d in pairwise(cuts))

        return [text(a, b) for a, b in zip(begins.tolist(), stops.tolist())]


@lru_cache
def model(path: str) -> PieceModel:
    """One a worker."""
    return PieceModel(path)


def _with_column(df: DataFrame, source: str, name: str, made: T.DataType, kernel, columns: list[str]) -> DataFrame:
    """The given columns of df, and one that kernel makes from source, one of them, some MB at once."""
    at_source = columns.index(source)
    out = T.StructType([*(df.schema[c] for c in columns), T.StructField(name, made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_leftovers()
        for batch in batches:
            values = batch.column(at_source)
            size = pc.binary_length(values) if pa.types.is_string(values.type) or pa.types.is_large_string(values.type) else pc.multiply(pc.list_value_length(values), 4)
            ends, at = np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BYTES_AT_ONCE, "right")))
                some = batch.slice(at, end - at)
                yield pa.record_batch([*(some.column(k) for k in range(len(columns))), kernel(some.column(at_source))], [f.name for f in out])
                at = end
        give_back()

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, out)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """docs with a column ids: the ids of each text by the model at path, without begin or end ids and without sampling.

    A null or empty text has no ids; texts of any length are encoded whole; repeated rows stay; an empty table gives an
    empty result. Other columns are carried along, but for one named ids.
    """

    def kernel(texts: pa.Array) -> pa.Array:
        ids, offsets = model(path).encode(raw_texts(texts))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))

    return _with_column(docs, "text", "ids", T.ArrayType(T.IntegerType()), kernel, [c for c in docs.columns if c != "ids"])


def decode(coded: DataFrame, path: str) -> DataFrame:
    """coded(ids) with a column decoded: the text that the ids stand for.

    Null or no ids give an empty text, control ids nothing, an unknown id a mark, bytes that aren't UTF-8 a replacement
    character each; an id outside the vocabulary, or null among ids, is an error. Other columns are carried along, but for one named
    decoded.
    """

    def kernel(lists: pa.Array) -> pa.Array:
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        if flat.null_count:
            raise ValueError("null among ids")
        return pa.array(model(path).decode(flat.to_numpy(), np.concatenate([[0], np.cumsum(counts)])), pa.string())

    return _with_column(coded, "ids", "decoded", T.StringType(), kernel, [c for c in coded.columns if c != "decoded"])
