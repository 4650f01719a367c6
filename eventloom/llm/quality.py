"""Quality rules whose thresholds follow each language and source."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import by_batch, cut, raw_texts, rolling, word_hashes

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Each signal: a count and what it is divided by.
SIGNALS = {"symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"), "word_length": ("word_chars", "n_words")}


def repeated_words(hashes: np.ndarray) -> int:
    """Words that lie in a window of WINDOW words that the text holds at least twice."""
    windows = rolling(hashes, WINDOW)
    if not len(windows):
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    repeated = np.zeros(len(windows), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(repeated), 1)
    np.add.at(edges, np.flatnonzero(repeated) + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def counts(text: bytes) -> tuple[int, int, int, int, int, int]:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    chars = len(text.decode()) - (len(text) - len(text.translate(None, SPACES)))
    return len(words), chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(word_hashes(words)), len(lines)


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the five counts and n_lines of each row of docs."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([counts(x) for x in raw_texts(batch.column(3))], np.int64).reshape(-1, len(COUNTS) + 1)
        return pa.record_batch([*batch.columns[:3], *map(pa.array, found.T.copy())], ["doc_id", "lang", "source", *COUNTS, "n_lines"])

    wanted = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    return by_batch(wanted, kernel, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in [*COUNTS, "n_lines"]))


#: Signals that may be too small as well as too large.
TWO_SIDED = ["word_length"]


def fences(passed: DataFrame, signals: dict[str, Column], quantile: float, accuracy: int, prior: float) -> DataFrame:
    """(of_lang, of_source, high_<signal>, low_<signal>): the limits of each language and source of passed.

    Each is a quantile of the group's own sketch, drawn to that of the language, and that to the corpus's, by the weight
    of prior documents: (n * own + prior * wider) / (n + prior). So a group's limits follow its own distribution the more
    the larger it is, by one formula at every size.
    """
    marks = [(f"high_{s}", s, quantile) for s in signals] + [(f"low_{s}", s, 1 - quantile) for s in TWO_SIDED]
    sketches = [F.percentile_approx(signals[s], q, accuracy).alias(m) for m, s, q in marks]
    names = [m for m, _, _ in marks]
    drawn = lambda own, wider: [((F.col("n") * F.col(own[m]) + prior * F.col(wider[m])) / (F.col("n") + prior)).alias(m) for m in names]
    corpus = passed.agg(*sketches).select(*[F.col(m).alias(f"corpus_{m}") for m in names])  # one row
    own = {m: m for m in names}
    languages = passed.groupBy("lang").agg(F.count("*").alias("n"), *sketches).join(F.broadcast(corpus)).select(F.col("lang").alias("its_lang"), *drawn(own, {m: f"corpus_{m}" for m in names}))
    wider = languages.select("its_lang", *[F.col(m).alias(f"lang_{m}") for m in names])
    groups = passed.groupBy("lang", "source").agg(F.count("*").alias("n"), *sketches).join(wider, F.col("lang").eqNullSafe(F.col("its_lang")))
    return groups.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), *drawn(own, {m: f"lang_{m}" for m in names}))


def judge_quality(docs: DataFrame, accuracy: int = 10_000, quantile: float = 0.95, prior: float = 30) -> DataFrame:
    """(doc_id, the five counts, base_failed, kept) for each row of docs(doc_id, text, lang, source).

    A document fails the base rules with fewer than 20 words or more than 30 % of its words in repeated windows. The
    others are held against their group, the documents of their language and source that passed the base rules: each
    signal, a count per word (duplicate lines per line), may not exceed the group's quantile of it, and the mean word
    length may not fall short of the opposite quantile either (fences()). Quantiles come from mergeable rank sketches
    (Greenwald-Khanna, rank error 1 / accuracy), which are built per partition and merged, so a group of any size moves a
    few kilobytes a partition. Verdicts are joined to the counts alone; texts aren't shuffled.

    A null text has no words and fails; null languages or sources form a group; null doc_ids and repeated rows stay; an
    empty table gives an empty result; other columns are ignored.
    """
    counted = cut(text_counts(docs))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = counted.withColumn("base_failed", failed)
    signals = {name: F.col(column) / F.greatest(F.col(per), F.lit(1)) for name, (column, per) in SIGNALS.items()}
    limits = cut(fences(judged.where(~F.col("base_failed")), signals, quantile, accuracy, prior))
    joined = judged.join(limits, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left")
    within = F.lit(True)
    for name in SIGNALS:
        within = within & (signals[name] <= F.col(f"high_{name}"))
        if name in TWO_SIDED:
            within = within & (signals[name] >= F.col(f"low_{name}"))
    return joined.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & F.coalesce(within, F.lit(False))).alias("kept"))
