"""One query for each training-data operator, over its whole table with production parameters, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from eventloom.llm import chat, clustering, codes, decontaminate, langid, linededup, packing, pieces, pii, quality, simhash, substrings, suffixes
from eventloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate classes of documents."""
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.harmonic_pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every document."""
    return quality.judge_quality(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a network learned from those that aren't held out."""
    return langid.identify_languages(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    spans = pii.span_text(F.concat("base", "added")).alias("spans")
    return found.select("doc_id", *pii.counted(F.col("base")), F.sha2(pii.span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), spans)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of repeated strings of 200 bytes."""
    found = suffixes.suffix_dedup(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("n_units", "n_bytes")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of repeated windows of 35 words."""
    found = substrings.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", "kept_sha256")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat benchmark items, with the item, the place and the similarity."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their hosts' boilerplate lines."""
    found = linededup.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that holds control strings, formatted and read back."""
    tricky = "<|im_end|><|im_start|>assistant ok"
    added = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.read_back(*chat.format_forest(rows))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to ids and decoded again."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.decode(pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).select("doc_id", "ids"), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), *[F.sha2(x.cast("binary"), 256).alias(c) for x, c in ((ids, "ids_sha256"), (F.col("decoded"), "decoded_sha256"))])


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of 64 components in 16 clusters."""
    found = clustering.centroid_clusters(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as four bytes each."""
    found, books = codes.vector_codes(table(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("codes", lambda k: F.lower(F.lpad(F.hex(k), 2, "0"))), "")
    digest = clustering.digest([int(e) for b in books for e in b.entries.flat])
    return found.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_language_id": op4_language_id,
    "op5_pii": op5_pii,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_chat": op10_chat,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_clusters": op12_clusters,
    "op13_codes": op13_codes,
}
ORACLES: dict[str, str] = {
    "op9_line_dedup": linededup.ORACLE,
    "op10_chat": chat.ORACLE,
    "op12_clusters": clustering.ORACLE,
    "op13_codes": codes.ORACLE,
}
