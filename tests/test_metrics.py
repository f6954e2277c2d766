from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.sql import functions as F

from textstyle.operators import metrics as M

SCHEMA = "label int, prediction double, score double"


def _scored(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_hand_made(spark):
    rows = [(0, 0.0, 0.1), (0, 1.0, 0.8), (1, 1.0, 0.8), (1, 1.0, 0.9)]
    row = M.calculate_metrics(_scored(spark, rows)).first()
    assert row["accuracy"] == row["recall"] == 0.75
    assert row["precision"] == pytest.approx(0.8333333)
    assert row["f1"] == pytest.approx(0.7333333)
    assert row["roc_auc"] == pytest.approx(0.875)


def _random_rows(n, seed, levels):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        label = int(rng.random() < 0.3)
        score = round(rng.random() * levels + label) / levels
        rows.append((label, float(score > 0.6), score))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_mllib(spark, seed):
    scored = _scored(spark, _random_rows(500, seed, 40)).cache()
    row = M.calculate_metrics(scored).first()
    for ours, theirs in [
        ("accuracy", "accuracy"),
        ("f1", "f1"),
        ("precision", "weightedPrecision"),
        ("recall", "weightedRecall"),
    ]:
        value = MulticlassClassificationEvaluator(metricName=theirs).evaluate(scored)
        assert row[ours] == pytest.approx(value, abs=1e-9)
    area = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(scored)
    assert row["roc_auc"] == pytest.approx(area, abs=1e-9)


def test_auc_by_brute_force_with_a_hot_score(spark):
    rows = _random_rows(300, 3, 1000) + [(i % 2, 0.0, 0.5) for i in range(150)]
    pos = [s for y, _, s in rows if y == 1]
    neg = [s for y, _, s in rows if y == 0]
    won = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    scored = _scored(spark, rows)
    for ranges in (1, 7, 200):
        got = M.roc_auc(scored, ranges=ranges).first()["roc_auc"]
        assert got == pytest.approx(won / len(pos) / len(neg), abs=1e-12)


def test_groups_and_missing_class(spark):
    rows = _scored(spark, [(1, 1.0, 0.9), (1, 0.0, 0.1)]).withColumn("model", F.lit("a"))
    row = M.calculate_metrics(rows, by=["model"]).first()
    assert row["model"] == "a" and row["roc_auc"] is None and row["recall"] == 0.5


def test_class_never_predicted(spark):
    rows = [(0, 0.0, 0.1), (1, 0.0, 0.2), (0, 2.0, 0.3)]
    scored = _scored(spark, rows)
    row = M.classification_metrics(scored).first()
    for ours, theirs in [("f1", "f1"), ("precision", "weightedPrecision")]:
        value = MulticlassClassificationEvaluator(metricName=theirs).evaluate(scored)
        assert row[ours] == pytest.approx(value)


def test_confusion_matrix(spark):
    rows = [(0, 0.0, 0.1), (0, 1.0, 0.8), (1, 1.0, 0.8), (1, 1.0, 0.9)]
    got = {r["label"]: (r["predicted_0"], r["predicted_1"]) for r in M.confusion_matrix(_scored(spark, rows)).collect()}
    assert got == {0: (1, 1), 1: (0, 2)}
