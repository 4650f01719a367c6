"""Sinks: coded events, stage snapshots, knowledge-base tables, pairs, scores and reports."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.knowledge import latest_by_title


def write_events(events: DataFrame, path: str) -> None:
    events.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def snapshot(df: DataFrame, folder: str, stage: str, now: datetime) -> str:
    """Writes a stage's rows under a folder named by the hour, and returns its path."""
    path = f"{folder}/{now:%Y_%m_%d-%H}_{stage}"
    df.write.mode("overwrite").parquet(path)
    return path


def upsert_articles(old: DataFrame | None, new: DataFrame, path: str) -> None:
    """Writes old and new articles to path, one per title, the newest; path must not be where old is read from."""
    rows = new.withColumn("ordinal", F.lit(1)) if old is None else old.withColumn("ordinal", F.lit(0)).unionByName(new.withColumn("ordinal", F.lit(1)), allowMissingColumns=True)
    latest_by_title(rows).drop("ordinal").write.mode("overwrite").parquet(path)


def write_redirects(redirects: DataFrame, path: str) -> None:
    """target and its titles as an array, so titles may hold any character."""
    redirects.write.mode("overwrite").parquet(path)


def write_pairs(pairs: DataFrame, path: str, by: str | None = None) -> None:
    """Training pairs as JSON lines, in a folder for each value of by if given."""
    writer = pairs.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def write_scores(scores: DataFrame, path: str) -> None:
    scores.write.mode("overwrite").option("header", True).csv(path)


def write_misses(results: DataFrame, path: str) -> None:
    """A line of text for each result(query, expected, found) that missed."""
    missed = results.where(~F.col("expected").eqNullSafe(F.col("found")))
    missed.select(F.format_string("query: %s | expected: %s | found: %s", "query", F.coalesce("expected", F.lit("-")), F.coalesce("found", F.lit("-"))).alias("value")).write.mode("overwrite").text(path)


def checkpointed(df: DataFrame, path: str) -> DataFrame:
    """df written to a new folder under path and read back: what comes after starts from there, also in several branches."""
    place = f"{path}/{uuid.uuid4().hex}"
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
