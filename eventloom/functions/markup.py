"""Paired brackets of wiki markup, found for a whole batch of texts at once by sums over the places of their marks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Fixed format values: namespaces of links that show a picture instead of text.
MEDIA = (b"file:", b"image:")
#: A batch is read in slices of rows of about so many bytes; one longer text is a slice of its own.
SLICE = 8 << 20
_HEADING = b"\n=="


class Texts:
    """UTF-8 bytes of many texts in a row: text i is data[offsets[i] : offsets[i + 1]]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        """The texts of a string column; null is empty."""
        column = column.cast(pa.large_string()).fill_null("")
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        return cls(raw, at - at[0])

    @classmethod
    def join(cls, texts: list[bytes]) -> Texts:
        return cls(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64))

    def rows(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, places, "right") - 1

    def where(self, phrase: bytes) -> np.ndarray:
        """All places where phrase begins, overlaps included; never across two texts."""
        n = len(self.data) - len(phrase) + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.data[:n] == phrase[0])
        for k in range(1, len(phrase)):
            at = at[self.data[at + k] == phrase[k]]
        return at[self.rows(at) == self.rows(at + len(phrase) - 1)]

    def without(self, inside: np.ndarray) -> Texts:
        """The texts without the bytes that inside marks."""
        kept = ~inside
        return Texts(self.data[kept], np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])[self.offsets])

    def before(self, phrase: bytes) -> Texts:
        """Each text up to the first phrase in it."""
        at = self.where(phrase)
        first = np.searchsorted(at, self.offsets[:-1])
        ends = np.append(at, len(self.data))[first]
        inside = np.zeros(len(self.data) + 1, np.int8)
        ends = np.minimum(ends, self.offsets[1:])
        np.add.at(inside, ends, 1)
        np.add.at(inside, self.offsets[1:], -1)
        return self.without(np.cumsum(inside[:-1], dtype=np.int8) > 0)

    def column(self) -> pa.Array:
        return pa.LargeStringArray.from_buffers(len(self.offsets) - 1, pa.py_buffer(np.ascontiguousarray(self.offsets)), pa.py_buffer(np.ascontiguousarray(self.data))).cast(pa.string())


def _every_second(at: np.ndarray) -> np.ndarray:
    """Of places that may overlap by one, those read from the left without overlap."""
    if not len(at):
        return at
    begins = np.concatenate([[True], np.diff(at) != 1])
    return at[(np.arange(len(at)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]) % 2 == 0]


def _unmatched(steps: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which steps down have no step up of their row left to undo."""
    sums = np.cumsum(steps)
    begins = np.concatenate([[True], np.diff(rows) != 0])
    own = sums - (sums - steps)[begins][np.cumsum(begins) - 1]
    apart = (np.cumsum(begins) - 1) * (len(steps) + 1)  # later rows lie below all earlier ones, so one running minimum serves all
    lowest = np.minimum.accumulate(np.minimum(own, 0) - apart) + apart
    earlier = np.where(begins, 0, np.concatenate([[0], lowest[:-1]]))
    return own < earlier


def outermost(texts: Texts, opening: bytes, closing: bytes, line_start: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the outermost pairs of two-byte brackets, marks included, in order.

    Brackets nest. A bracket without its partner in the same text is no bracket. With line_start, only those that begin a line count.
    """

    def marks(phrase: bytes) -> np.ndarray:
        at = texts.where(phrase)
        at = _every_second(at) if phrase[0] == phrase[1] else at
        return at[(texts.offsets[texts.rows(at)] == at) | (texts.data[at - 1] == 10)] if line_start else at

    opens, closes = marks(opening), marks(closing)
    places, steps = np.concatenate([opens, closes]), np.repeat([1, -1], [len(opens), len(closes)])
    order = np.argsort(places, kind="stable")
    places, steps = places[order], steps[order]
    if not len(places):
        return places, places
    rows = texts.rows(places)
    lone = _unmatched(steps, rows) | _unmatched(-steps[::-1], -rows[::-1])[::-1]
    places, steps = places[~lone], steps[~lone]
    depth = np.cumsum(steps)
    return places[(steps == 1) & (depth == 1)], places[(steps == -1) & (depth == 0)] + 2


def covered(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which bytes lie in spans that don't overlap."""
    edges = np.zeros(len(texts.data) + 1, np.int8)
    edges[starts] += 1
    edges[ends] -= 1
    return np.cumsum(edges[:-1], dtype=np.int8) > 0


def _infoboxes(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> list[bytes | None]:
    """The inside of each text's first template that is an infobox."""
    found: list[bytes | None] = [None] * (len(texts.offsets) - 1)
    for row, a, b in zip(texts.rows(starts).tolist(), (starts + 2).tolist(), (ends - 2).tolist()):
        if found[row] is None:
            name = texts.data[a : min(b, a + 40)].tobytes().decode(errors="ignore").lstrip()
            if len(name) < 7:  # many spaces
                name = texts.data[a:b].tobytes().decode().lstrip()
            if name[:7].lower() == "infobox":
                found[row] = texts.data[a:b].tobytes()
    return found


def _fields(boxes: list[bytes | None]) -> list[tuple[str | None, dict[str, str]]]:
    """Type and fields of each infobox: parted at the bars that stand in no template or link of its."""
    texts = Texts.join([b or b"" for b in boxes])
    inner = covered(texts, *outermost(texts, b"{{", b"}}")) | covered(texts, *outermost(texts, b"[[", b"]]"))
    bars = np.flatnonzero((texts.data == ord("|")) & ~inner)
    first = np.searchsorted(bars, texts.offsets).tolist()
    bars, offsets, out = bars.tolist(), texts.offsets.tolist(), []
    for row, box in enumerate(boxes):
        if box is None:
            out.append((None, {}))
            continue
        at = [b - offsets[row] for b in bars[first[row] : first[row + 1]]]
        kind, *parts = [box[a:b].decode() for a, b in zip([0, *[x + 1 for x in at]], [*at, len(box)])]
        pairs = [(k.strip(), v.strip()) for k, eq, v in (p.partition("=") for p in parts) if eq]
        out.append((kind.strip()[len("infobox") :].strip(), {k: v for k, v in pairs if k and v}))
    return out


def _media(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = outermost(texts, b"[[", b"]]")
    shown = np.array([texts.data[a + 2 : a + 12].tobytes().lstrip().lower().startswith(MEDIA) for a in starts.tolist()], bool)
    return starts[shown], ends[shown]


def _slices(column: pa.Array) -> list[pa.Array]:
    """The column in slices of about SLICE bytes."""
    offsets, cuts = Texts.of(column).offsets, [0]
    while cuts[-1] < len(column):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(offsets, offsets[cuts[-1]] + SLICE, "right")) - 1))
    return [column.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]


def read_pages(column: pa.Array) -> tuple[list[str | None], list[list[tuple[str, str]]], pa.Array]:
    """Box type and fields of each text's first infobox (null and none without one), and its introduction.

    The introduction is what stands before the first heading, without templates, tables, pictures and their captions.
    """
    kinds, fields, intros = [], [], [pa.array([], pa.string())]
    for part in _slices(column):
        texts = Texts.of(part)
        starts, ends = outermost(texts, b"{{", b"}}")
        for kind, found in _fields(_infoboxes(texts, starts, ends)):
            kinds.append(kind)
            fields.append(list(found.items()))
        intro = texts.without(covered(texts, starts, ends)).before(_HEADING)
        intro = intro.without(covered(intro, *outermost(intro, b"{|", b"|}", line_start=True)))
        intros.append(intro.without(covered(intro, *_media(intro))).column())
    return kinds, fields, pa.concat_arrays(intros)
