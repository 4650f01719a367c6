"""Scores of classifiers and rankers, grouped splits, ablations."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def classification_report(rows: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support) of rows(label, predicted), and accuracy on each row; one aggregation over the confusion counts."""
    confusion = rows.groupBy("label", "predicted").agg(F.count("*").alias("n"))
    one = confusion.select(F.explode(F.array(F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).alias("predicted")), F.struct(F.col("predicted").alias("class"), F.lit(0).alias("support"), F.col("n").alias("predicted")))).alias("x"), F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"))
    sums = one.groupBy("x.class").agg(F.sum("x.support").alias("support"), F.sum("x.predicted").alias("predicted"), (F.sum("hit") / 2).alias("hits"))
    precision, recall = F.try_divide(F.col("hits"), F.col("predicted")), F.try_divide(F.col("hits"), F.col("support"))
    f1 = F.try_divide(2 * F.col("hits"), F.col("predicted") + F.col("support"))
    return sums.select(F.col("class").alias("label"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support")


def grouped_split(rows: DataFrame, group: str, train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """rows with split, train or test: all rows of a group go to the same side, by its digest."""
    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(group).cast("string"))), 1, 8), 16, 10).cast("long")
    return rows.withColumn("split", F.when(place < int(train_share * (1 << 32)), "train").otherwise("test"))


def balance_shares(importance: DataFrame) -> DataFrame:
    """(feature, share, rank): each feature's share of the total of importance(feature, value), largest first."""
    total = importance.agg(F.sum("value").alias("total"))
    shares = importance.join(F.broadcast(total)).select("feature", F.try_divide(F.col("value"), F.col("total")).alias("share"))
    return shares.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("share"), "feature")))


def group_sizes(rows: DataFrame, group: str, member: str, value: str) -> DataFrame:
    """(group, members, top, n): how many different members each group has, its greatest value and its number of rows; null members count as none."""
    return rows.groupBy(group).agg(F.count_distinct(member).alias("members"), F.max(value).alias("top"), F.count("*").alias("n"))


def grid(**settings: list) -> list[dict]:
    """All combinations of the settings: what a boost search or an ablation runs over, as driver-side parameters."""
    return [dict(zip(settings, values)) for values in product(*settings.values())]


def ablations(features: list[str], drops: dict[str, list[str]], sizes: list[int], seeds: list[int]) -> list[dict]:
    """The runs of an ablation: named feature sets without their dropped features, by training size and seed."""
    return [{"name": n, "features": [f for f in features if f not in drops[n]], "size": s, "seed": k} for n, s, k in product(drops, sizes, seeds)]
