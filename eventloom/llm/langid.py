"""Language identification by a byte-level convolutional network, trained in numpy."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from eventloom.llm.common import by_batch, raw_texts

UNDETERMINED = "und"
#: Windows whose features are computed at once: bounds memory for a very long text.
BLOCK = 64
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Shape:
    """Sizes of the network and of its training.

    train_rows bounds the labelled rows that are learned from: those with the least hash of doc_id and text, of each of
    which windows_per_row windows of window bytes are used.
    """

    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    embedding: int = 8
    train_rows: int = 4000
    windows_per_row: int = 2
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


class ByteNet:
    """Byte embedding, filters of several widths, ReLU, max pooling over the window and a softmax layer.

    Byte 0 pads short windows. As a filter is linear in the embedded bytes, each filter tap is a table of 256 rows, and
    applying it is a lookup.
    """

    def __init__(self, shape: Shape, languages: list[str]):
        rng = np.random.default_rng(shape.seed)
        self.shape, self.languages = shape, languages
        normal = lambda *size, scale: rng.normal(0, scale, size).astype(np.float32)
        self.weights = {"embedding": normal(256, shape.embedding, scale=0.5)}
        for w in shape.widths:
            self.weights[f"filter{w}"] = normal(w, shape.embedding, shape.filters, scale=(w * shape.embedding) ** -0.5)
            self.weights[f"bias{w}"] = np.zeros(shape.filters, np.float32)
        self.weights["out"] = normal(len(shape.widths) * shape.filters, len(languages), scale=0.1)
        self.weights["out_bias"] = np.zeros(len(languages), np.float32)

    def tables(self) -> dict[int, list[np.ndarray]]:
        return {w: [self.weights["embedding"] @ tap for tap in self.weights[f"filter{w}"]] for w in self.shape.widths}

    def features(self, windows: np.ndarray, tables: dict[int, list[np.ndarray]], places: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """Pooled features of windows(n, window) and, for training, where in the window each maximum is."""
        pooled, where = [], []
        for w, taps in tables.items():
            n = windows.shape[1] - w + 1
            total = taps[0][windows[:, :n]]
            for o in range(1, w):
                total += taps[o][windows[:, o : o + n]]
            if places:
                where.append(at := total.argmax(axis=1))
                best = np.take_along_axis(total, at[:, None, :], axis=1)[:, 0]
            else:
                best = total.max(axis=1)
            pooled.append(np.maximum(best + self.weights[f"bias{w}"], 0))
        return np.concatenate(pooled, axis=1), where

    def log_probabilities(self, windows: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        scores = self.features(windows, tables)[0] @ self.weights["out"] + self.weights["out_bias"]
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))

    def gradients(self, windows: np.ndarray, targets: np.ndarray, row_weights: np.ndarray) -> dict[str, np.ndarray]:
        tables = self.tables()
        features, where = self.features(windows, tables, places=True)
        scores = features @ self.weights["out"] + self.weights["out_bias"]
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        error = scores / scores.sum(axis=1, keepdims=True)
        error[np.arange(len(targets)), targets] -= 1
        error *= row_weights[:, None] / len(targets)
        back = (error @ self.weights["out"].T) * (features > 0)
        found = {"out": features.T @ error, "out_bias": error.sum(axis=0), "embedding": np.zeros_like(self.weights["embedding"])}
        size = self.shape.filters
        for k, w in enumerate(self.shape.widths):
            part, filters = back[:, k * size : (k + 1) * size], self.weights[f"filter{w}"]
            found[f"bias{w}"], grown = part.sum(axis=0), np.zeros_like(filters)
            for o in range(w):
                seen = np.take_along_axis(windows, where[k] + o, axis=1)  # the byte under this tap at each maximum
                grown[o] = np.einsum("nfe,nf->ef", self.weights["embedding"][seen], part)
                np.add.at(found["embedding"], seen.ravel(), (part[:, :, None] * filters[o].T[None]).reshape(-1, filters.shape[1]))
            found[f"filter{w}"] = grown
        return found

    def fit(self, windows: np.ndarray, targets: np.ndarray) -> None:
        """Adam on the cross entropy; each language has the same weight in total."""
        shape, rng = self.shape, np.random.default_rng(self.shape.seed)
        counts = np.bincount(targets, minlength=len(self.languages))
        row_weights = (len(targets) / (len(self.languages) * np.maximum(counts, 1)))[targets].astype(np.float32)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square, step = {k: np.zeros_like(v) for k, v in self.weights.items()}, 0
        for _ in range(shape.epochs):
            order = rng.permutation(len(targets))
            for at in range(0, len(order), shape.batch):
                rows, step = order[at : at + shape.batch], step + 1
                for k, g in self.gradients(windows[rows], targets[rows], row_weights[rows]).items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    self.weights[k] -= shape.rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)


def cut_windows(text: bytes, size: int) -> np.ndarray:
    """The whole text as windows(n, size), the last one padded with zeros; at least one."""
    n = max(1, -(-len(text) // size))
    out = np.zeros(n * size, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, size)


def train(labelled: DataFrame, shape: Shape = Shape()) -> ByteNet | None:
    """A network learned from labelled(doc_id, text, lang); None if no row has text, language and doc_id.

    The sample is the train_rows rows with the least hash of doc_id and text; its windows are chosen by another hash,
    before anything comes to the driver. Rows are counted first, so that tasks pass on only hashes under a limit which
    about twice train_rows stay below. If repeated rows, which share a hash, leave fewer than that below the limit, it is
    raised until there are enough or all rows are below it; the sample is the same whatever the limit. The driver gets
    those rows' windows_per_row pieces of window characters, however many tasks there are.
    """
    named = labelled.select("doc_id", "text", "lang").where("doc_id is not null and lang is not null").where(F.length("text") > 0)
    total = named.count()
    share, rows = min(1.0, 2 * shape.train_rows / max(total, 1)), []
    while len(rows) < min(shape.train_rows, total):
        rows = _sample(named, shape, share)
        if share == 1.0:
            break
        share = min(1.0, 8 * share)
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    net = ByteNet(shape, languages)
    examples = [(cut_windows(p.encode(), shape.window)[0], languages.index(r.lang)) for r in rows for p in r.parts]
    net.fit(np.stack([w for w, _ in examples]), np.array([t for _, t in examples]))
    return net


def _sample(named: DataFrame, shape: Shape, share: float) -> list[Row]:
    """(lang, parts) of the first train_rows rows in order of the hash of doc_id and text, of those in the lowest share of all hashes."""
    limit = min(int(share * (1 << 64)) - (1 << 63), (1 << 63) - 1)
    starts = [F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(F.length("text") - shape.window, F.lit(1))).cast("int") + 1 for k in range(shape.windows_per_row)]
    parts = F.array(*[F.substring(F.col("text"), s, F.lit(shape.window)) for s in starts])
    hashed = named.withColumn("h", F.xxhash64("doc_id", "text")).where(F.col("h") <= limit)
    return hashed.select("h", "doc_id", "lang", parts.alias("parts")).orderBy("h", "doc_id", "lang", "parts").limit(shape.train_rows).collect()


class Classifier:
    """The language and score of whole texts."""

    def __init__(self, net: ByteNet | None):
        self.net, self.tables = net, net.tables() if net else {}

    def __call__(self, text: bytes) -> tuple[str, float]:
        net = self.net
        if net is None or not _LETTER.search(text.decode()):
            return UNDETERMINED, 0.0
        windows, total = cut_windows(text, net.shape.window), np.zeros(len(net.languages))
        for at in range(0, len(windows), BLOCK):
            total += net.log_probabilities(windows[at : at + BLOCK], self.tables).sum(axis=0)
        total = np.exp((total - total.max()) / len(windows))
        best = int(total.argmax())
        return net.languages[best], float(total[best] / total.sum())


def predict(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """docs with lang_pred and score for each row's text.

    The whole text is cut into windows of equal length; the mean of their log probabilities, normalised, is the
    document's distribution, its maximum the prediction and score. A null text, or one without any letter, is
    undetermined with score 0, as is every text if nothing could be learned; null doc_ids and repeated rows stay, and an
    empty table gives an empty result. Columns that are called lang_pred or score already are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    classify, at = Classifier(net), docs.columns.index("text")

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [classify(x) for x in raw_texts(batch.column(at))]
        columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
        return pa.record_batch([*batch.columns, *columns], [*batch.schema.names, "lang_pred", "score"])

    return by_batch(docs, kernel, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def held_out() -> Column:
    """Whether a document is kept from training: the CRC-32 of its id as text is 2 modulo 4 (false for a null id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): predictions for docs(doc_id, text, lang), learned from those not held out."""
    net = train(docs.where(~held_out()), shape)
    return predict(docs.select("doc_id", "text"), net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, shape: Shape = Shape(), min_score: float = 0.5) -> DataFrame:
    """docs without the rows whose language is undetermined or has a score under min_score; all columns, no shuffle.

    A null text, or one without any letter, goes; null doc_ids and repeated rows go or stay by their text alone; an empty
    table stays empty; no other column than text is read for a verdict.
    """
    classify, at = Classifier(train(docs.where(~held_out()), shape)), docs.columns.index("text")

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [classify(x) for x in raw_texts(batch.column(at))]
        return batch.filter(pa.array([x[0] != UNDETERMINED and x[1] >= min_score for x in found], pa.bool_()))

    return by_batch(docs, kernel, docs.schema)
