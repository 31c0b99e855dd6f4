from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

from dayledger.operators import metrics
from dayledger.plans.model import evaluate_exact


def scores(spark, seed, n=400, levels=30):
    rnd = random.Random(seed)
    rows = [(float(rnd.random() < 0.3), float(rnd.random() < 0.4), rnd.randrange(levels) / levels) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "label DOUBLE, prediction DOUBLE, score DOUBLE").repartition(5)


def pairwise_auc(rows):
    """Share of positive/negative pairs in the right order, ties half."""
    pos = [s for label, _, s in rows if label > 0.5]
    neg = [s for label, _, s in rows if label <= 0.5]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("seed, levels", [(1, 30), (2, 3), (3, 100_000)])
def test_auc_equals_pairs_and_evaluator(spark, seed, levels):
    rows, frame = scores(spark, seed, levels=levels)
    got = metrics.auc(frame, "label", "score").first()["auc"]
    assert got == pytest.approx(pairwise_auc(rows), abs=1e-12)
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert got == pytest.approx(exact.evaluate(frame), abs=1e-9)


def test_auc_with_a_score_shared_by_a_third_of_rows(spark):
    rows, _ = scores(spark, 4, n=300)
    rows += [(float(i % 3 == 0), 1.0, 0.5) for i in range(150)]
    frame = spark.createDataFrame(rows, "label DOUBLE, prediction DOUBLE, score DOUBLE")
    assert metrics.auc(frame, "label", "score").first()["auc"] == pytest.approx(pairwise_auc(rows), abs=1e-12)


def test_auc_of_one_class_is_zero(spark):
    frame = spark.createDataFrame([(1.0, 0.2), (1.0, 0.4)], "label DOUBLE, score DOUBLE")
    assert metrics.auc(frame, "label", "score").first()["auc"] == 0.0


@pytest.mark.parametrize("seed", [5, 6])
def test_accuracy_and_f1_equal_evaluators(spark, seed):
    _, frame = scores(spark, seed)
    judge = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    accuracy = metrics.accuracy(frame, "label", "prediction").first()["accuracy"]
    f1 = metrics.f1(frame, "label", "prediction").first()["f1"]
    assert accuracy == pytest.approx(judge.setMetricName("accuracy").evaluate(frame), abs=1e-12)
    assert f1 == pytest.approx(judge.setMetricName("f1").evaluate(frame), abs=1e-12)
    together = evaluate_exact(frame, "label", "prediction", "score").first()
    assert (together["accuracy"], together["f1"]) == (accuracy, f1)


def test_f1_with_a_class_never_predicted(spark):
    rows = [(0.0, 0.0), (1.0, 0.0), (1.0, 0.0), (2.0, 2.0), (0.0, 3.0)]
    frame = spark.createDataFrame(rows, "label DOUBLE, prediction DOUBLE")
    judge = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1")
    assert metrics.f1(frame, "label", "prediction").first()["f1"] == pytest.approx(judge.evaluate(frame))


def test_best_point_is_the_first_on_a_tie(spark):
    folds = spark.createDataFrame(
        [(0, 0.5), (0, 0.7), (1, 0.9), (1, 0.7), (2, 0.8), (2, 0.8)], "grid_id INT, metric DOUBLE"
    )
    means = metrics.cv_means(folds, "grid_id", "metric")
    assert metrics.cv_best(means, "grid_id").first()["grid_id"] == 1
