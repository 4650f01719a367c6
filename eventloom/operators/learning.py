"""Trained scorers on Spark ML: the event classifiers and the article ranker."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.evaluation import ablations, grouped_split
from eventloom.operators.pairs import draw
from eventloom.operators.ranking import choose_by_model


@dataclass(frozen=True)
class EventScorer:
    """A binary model for each event type over an embedding column."""

    models: dict[str, LogisticRegressionModel]

    def score(self, rows: DataFrame) -> DataFrame:
        """rows with probabilities, an array in the order of the models."""
        scored = rows.withColumn("_v", array_to_vector(F.col("embedding").cast("array<double>")))
        for k, model in enumerate(self.models.values()):
            m = model.copy().setFeaturesCol("_v").setProbabilityCol(f"_p{k}").setRawPredictionCol(f"_r{k}").setPredictionCol(f"_c{k}")
            scored = m.transform(scored).withColumn(f"_p{k}", F.get(vector_to_array(f"_p{k}"), F.lit(1))).drop(f"_r{k}", f"_c{k}")
        names = [f"_p{k}" for k in range(len(self.models))]
        return scored.withColumn("probabilities", F.array(*names)).drop("_v", *names)

    def save(self, path: str) -> None:
        """Writes each label's model to a folder of its own under path; numbers keep the order of the labels."""
        for k, (label, model) in enumerate(self.models.items()):
            model.write().overwrite().save(f"{path}/{k:04d}-{label}")


def load_event_scorer(path: str, labels: list[str]) -> EventScorer:
    """The scorer that save() wrote for these labels."""
    return EventScorer({label: LogisticRegressionModel.load(f"{path}/{k:04d}-{label}") for k, label in enumerate(labels)})


def balanced_examples(rows: DataFrame, label: str, negatives: int = 3, below: float = 0.05, seed: int = 7) -> DataFrame:
    """Positives of a label, and at most negatives times as many others whose probability of it is under the limit, with balancing weights.

    Others are taken by the order of draw() up to a threshold that their count gives, so nothing is sorted or gathered.
    """
    positive = rows.where(F.col("label") == label).withColumn("y", F.lit(1.0))
    other = rows.where((F.col("label") != label) & (F.col("p_event") < below)).withColumn("y", F.lit(0.0))
    n, m = positive.count(), other.count()
    share = min(1.0, negatives * n / m) if m else 1.0
    drawn = other.where(F.conv(F.substring(draw(seed, "id"), 1, 8), 16, 10).cast("long") < int(share * (1 << 32)))
    return positive.unionByName(drawn).withColumn("weight", F.when(F.col("y") == 1, 1.0 / max(n, 1)).otherwise(1.0 / max(share * m, 1)))


def fit_event_scorer(rows: DataFrame, labels: list[str]) -> EventScorer:
    """Models for labels from rows(id, embedding, label, p_event)."""
    models = {}
    for label in labels:
        examples = balanced_examples(rows, label).withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
        models[label] = LogisticRegression(featuresCol="features", labelCol="y", weightCol="weight", maxIter=30, regParam=0.01).fit(examples)
    return EventScorer(models)


def fit_ranker(scores: DataFrame, features: list[str], trees: int = 50, depth: int = 4, seed: int = 42) -> PipelineModel:
    """A gradient-boosted ranker of candidates from scores(features, correct)."""
    from pyspark.ml import Pipeline

    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, GBTClassifier(labelCol="correct", maxIter=trees, maxDepth=depth, seed=seed)]).fit(scores)


def ranker_probability(model: PipelineModel, scores: DataFrame) -> DataFrame:
    return model.transform(scores).withColumn("probability", F.get(vector_to_array("probability"), F.lit(1))).drop("features", "rawPrediction", "prediction")


def run_ablations(scores: DataFrame, features: list[str], drops: dict[str, list[str]], sizes: list[int], seeds: list[int], trees: int = 5, depth: int = 3) -> list[dict]:
    """name, size, seed and accuracy of a ranker for each named set of dropped features, training size and seed.

    scores has task, article_id, rank, features and correct. Tasks are split once; a run learns from size tasks of the
    training side, drawn by its seed, and is scored on all tasks of the test side: the share whose best candidate is
    correct. Only these shares come to the driver.
    """
    split = grouped_split(scores, "task")
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    found = []
    for run in ablations(features, drops, sizes, seeds):
        tasks = train.select("task").distinct().orderBy(draw(run["seed"], "task"), "task").limit(run["size"])
        model = fit_ranker(train.join(tasks, "task"), run["features"], trees, depth, run["seed"])
        best = choose_by_model(ranker_probability(model, test), F.col("probability"), threshold=-1.0).select("task", "article_id")
        right = test.select("task", "article_id", "correct").join(best, ["task", "article_id"]).agg(F.avg("correct").alias("accuracy")).first()
        found.append({"name": run["name"], "size": run["size"], "seed": run["seed"], "accuracy": right.accuracy})
    return found
