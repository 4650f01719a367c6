"""Where queries are registered, each with its DuckDB equivalent if SQL can express it."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "p1_story_events"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a function of (spark, sf_dir) under its name."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder of spark.checkpoint.dir; where that is unset a local one, in a local session alone."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared or '/tmp/checkpoints'}/scratch-{uuid.uuid4().hex}"
