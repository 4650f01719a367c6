"""Shuffles whose tasks stay as large as they are when tables grow, also where one key has very many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more rows than this is dealt to several tasks, of about so many rows of it each.
COMMON = 20_000


def tasks(spark: SparkSession, rows: float, each: int) -> int:
    """Among how many tasks so many rows are dealt: about each rows to one, and no fewer than Spark's shuffles have."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(-(-rows // each)))


def dealt(df: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """df, shuffled by keys to n tasks; as it is without n, where Spark chooses."""
    return df.repartition(n, *keys) if n else df


def shuffled(df: DataFrame) -> DataFrame:
    """df, for a join whose two sides both grow with the input: the join shuffles them. Without this Spark goes by the size
    of files, and the driver gathers and sends out a table of short rows: 1.35 million of them are 9 MB of Parquet."""
    return df.hint("merge")


def spread_join(many: DataFrame, few: DataFrame, on: list[str], by: Column, sizes: DataFrame, how: str = "inner", n: int | None = None) -> DataFrame:
    """many joined with few (how: inner or left), where a key may have very many rows of many.

    sizes(on, n) has the number of rows of many by key. A key of over COMMON rows is dealt to several tasks by a hash of
    by, and few's rows of it go to each of them; of an inner join, what few doesn't hold of such keys isn't shuffled. Keys
    of over COMMON rows are at most the rows of many divided by COMMON, and are sent to all tasks; nothing else is.
    """
    common = sizes.where(F.col("n") > COMMON).select(*on, F.ceil(F.col("n") / COMMON).cast("int").alias("_parts"))
    dealt_many = many.join(F.broadcast(common), on, "left")
    if how == "inner":
        held = few.join(F.broadcast(common.select(*on)), on).select(*on).distinct().withColumn("_held", F.lit(True))
        dealt_many = many.join(F.broadcast(common.join(F.broadcast(held), on, "left")), on, "left").where("_parts is null or _held").drop("_held")
    dealt_many = dealt_many.withColumn("_part", F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    dealt_few = few.join(F.broadcast(common), on, "left").withColumn("_part", F.explode(parts)).drop("_parts")
    keys = [*on, "_part"]
    return dealt(dealt_many, n, *keys).join(shuffled(dealt(dealt_few, n, *keys)), keys, how).drop("_part")
