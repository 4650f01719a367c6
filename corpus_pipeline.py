"""From documents to packed training sequences: five stages, each one of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import decontaminate, langid, linededup, packing, simhash
from eventloom.llm.common import cut, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language the network can't tell."""
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each host's boilerplate lines out of its texts; n_chars follows."""
    columns = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    shortened = linededup.drop_boilerplate(docs.select("text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    return shortened.select(*[columns.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each near-duplicate class."""
    return simhash.keep_one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that repeat a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens."""
    return packing.harmonic_pack(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=150_000, at_once=2 << 20)  # the other stages' memory stays with the executor


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: SQL can run neither the network nor the tokenizer; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the checkpoint folder before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
