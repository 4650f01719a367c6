"""Trained scorers on data whose right answers are known."""

import pytest
from pyspark.sql import functions as F

from eventloom.operators import learning
from eventloom.operators.ranking import choose_by_model


@pytest.fixture(scope="module")
def embedded(spark):
    """Label a where the first coordinate is positive; p_event over the limit for a fifth of the others."""
    rows = [(i, [1.0 if i % 4 == 0 else -1.0, (i % 7) / 7.0], "a" if i % 4 == 0 else "b", 0.2 if i % 5 == 0 else 0.01) for i in range(400)]
    return spark.createDataFrame(rows, "id long, embedding array<double>, label string, p_event double")


def test_balanced_examples(embedded):
    rows = learning.balanced_examples(embedded, "a", negatives=2).collect()
    positive, other = [r for r in rows if r.y == 1], [r for r in rows if r.y == 0]
    assert {r.id for r in positive} == set(range(0, 400, 4))
    assert all(r.label == "b" and r.p_event < 0.05 for r in other) and 150 <= len(other) <= 240
    assert sum(r.weight for r in positive) == pytest.approx(1) and sum(r.weight for r in other) == pytest.approx(1, rel=0.2)


def test_event_scorer_separates(embedded):
    scored = learning.fit_event_scorer(embedded, ["a", "b"]).score(embedded).collect()
    assert all((r.probabilities[0] > 0.5) == (r.label == "a") and (r.probabilities[1] > 0.5) == (r.label == "b") for r in scored)


def test_saved_scorer_scores_alike(embedded, tmp_path):
    scorer = learning.fit_event_scorer(embedded, ["a", "b"])
    scorer.save(f"{tmp_path}/models")
    one, two = (s.score(embedded).orderBy("id").select("probabilities").collect() for s in (scorer, learning.load_event_scorer(f"{tmp_path}/models", ["a", "b"])))
    assert one == two


@pytest.fixture(scope="module")
def candidates(spark):
    """Ten candidates a task, of which the one with the flag is correct; noise tells nothing."""
    rows = [(t, 10 * t + k, k, int(k == t % 10), (7 * t + 3 * k) % 5, float(k == t % 10)) for t in range(80) for k in range(10)]
    return spark.createDataFrame(rows, "task long, article_id long, rank int, flag int, noise int, correct double")


def test_ranker_finds_the_flag(candidates):
    model = learning.fit_ranker(candidates, ["flag", "noise"], trees=3, depth=2)
    best = choose_by_model(learning.ranker_probability(model, candidates), F.col("probability")).collect()
    assert {r.task: r.article_id for r in best} == {t: 10 * t + t % 10 for t in range(80)}


def test_ablation_shows_what_a_feature_is_worth(candidates):
    runs = learning.run_ablations(candidates, ["flag", "noise"], {"all": [], "no flag": ["flag"]}, [40], [1], trees=2, depth=2)
    accuracy = {r["name"]: r["accuracy"] for r in runs}
    assert accuracy["all"] == 1.0 and accuracy["no flag"] < 0.5
