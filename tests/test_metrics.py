"""Metric operators against published figures, MLlib's evaluators and brute force."""

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from incidentlake.operators import metrics as m
from incidentlake.operators.learning import auc_roc, balanced_weight, with_class_weights
from incidentlake.schema import CONFUSION_SCHEMA

# Published confusion counts (label, prediction, count)
BINARY = [(0.0, 0.0, 331722), (0.0, 1.0, 5120), (1.0, 0.0, 36905), (1.0, 1.0, 25826)]
PROTOCOL = [
    (0.0, 0.0, 196794), (0.0, 1.0, 20206), (0.0, 2.0, 26263), (0.0, 3.0, 27502),
    (1.0, 0.0, 11838), (1.0, 1.0, 32140), (1.0, 2.0, 1582), (1.0, 3.0, 4842),
    (2.0, 0.0, 9753), (2.0, 1.0, 3011), (2.0, 2.0, 19278), (2.0, 3.0, 34721),
    (3.0, 0.0, 648), (3.0, 1.0, 719), (3.0, 2.0, 2121), (3.0, 3.0, 8151),
]


def test_published_binary_metrics(frame):
    row = m.classification_metrics(frame(BINARY, CONFUSION_SCHEMA), positive=True).first()
    assert row["accuracy"] == pytest.approx(0.8948252259286789, abs=1e-12)
    assert row["f1"] == pytest.approx(0.8793514361292956, abs=1e-12)
    assert row["precision"] == pytest.approx(0.8896280159291706, abs=1e-12)
    assert row["recall"] == pytest.approx(row["accuracy"], abs=1e-12)
    assert row["recall_arrested"] == pytest.approx(0.4116943775804626, abs=1e-12)


def test_published_protocol_metrics(frame):
    row = m.classification_metrics(frame(PROTOCOL, CONFUSION_SCHEMA), k=4).first()
    wanted = {
        "accuracy": 0.6415988227314932, "f1": 0.6816854378571162,
        "precision": 0.7497054912810046, "recall_class0": 0.7268073790925711,
        "recall_class1": 0.6376731082099917, "recall_class2": 0.28875275227296554,
        "recall_class3": 0.7003178967265229,
    }
    assert {k: row[k] for k in wanted} == pytest.approx(wanted, abs=1e-12)


def test_dense_matrix(frame):
    rows = m.confusion_matrix(frame(PROTOCOL[:5], CONFUSION_SCHEMA), 4).orderBy("label").collect()
    assert [tuple(r)[1:] for r in rows] == [
        (196794, 20206, 26263, 27502), (11838, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0)]


def test_metrics_agree_with_mllib(spark):
    preds = spark.range(500).select(
        (F.col("id") * 7 % 5).cast("double").alias("label"),
        (F.col("id") * 11 % 4).cast("double").alias("prediction"))  # class 4 never predicted
    ours = m.classification_metrics(m.confusion(preds), k=6).first()
    for name, metric in {"accuracy": "accuracy", "f1": "f1", "precision": "weightedPrecision",
                         "recall": "weightedRecall"}.items():
        theirs = MulticlassClassificationEvaluator(metricName=metric).evaluate(preds)
        assert ours[name] == pytest.approx(theirs, abs=1e-9)
    assert ours["recall_class4"] == 0.0 and ours["recall_class5"] == 0.0


def test_regression_agrees_with_mllib(spark):
    preds = spark.range(300).select(
        (F.col("id") % 17).cast("double").alias("label"),
        (F.col("id") % 13 + 0.5).alias("prediction"))
    ours = m.regression_metrics(preds).first()
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(metricName=name).evaluate(preds)
        assert ours[name] == pytest.approx(theirs, abs=1e-9)


def test_balanced_weights(frame):
    rows = [(0.0,)] * 6 + [(1.0,)] * 3 + [(3.0,)]
    df = with_class_weights(frame(rows, "label double"), "balanced", 4)
    found = {r[0]: r[1] for r in df.distinct().collect()}
    assert found == pytest.approx({0.0: 10 / 24, 1.0: 10 / 12, 3.0: 2.5})
    # every class that occurs weighs N / k in total
    totals = df.groupBy("label").agg(F.sum("classWeight")).collect()
    assert [t[1] for t in totals] == pytest.approx([2.5] * 3)


def test_published_rare_class_weight(spark):
    # 2,000,000 rows of which 58,518 are in class 3
    assert 2_000_000 / (4 * 58_518) == pytest.approx(8.54, abs=0.01)
    df = spark.range(20_000).select(F.when(F.col("id") < 585, 3.0).otherwise(0.0).alias("label"))
    weight = df.filter("label = 3").limit(1).select(balanced_weight(df, 4)).first()[0]
    assert weight == pytest.approx(20_000 / (4 * 585))


def test_binary_weights(frame):
    df = with_class_weights(frame([(1.0,)] + [(0.0,)] * 3, "label double"), "binary")
    assert dict(r[:] for r in df.distinct().collect()) == {1.0: 0.75, 0.0: 0.25}


def test_roc_points_by_brute_force(spark):
    rng = np.random.default_rng(5)
    scores = np.concatenate([rng.random(200), np.linspace(0, 1, 100), [0.0, 1.0]])
    labels = (rng.random(len(scores)) < 0.4).astype(float)
    rows = list(zip(map(float, labels), map(float, scores))) + [(1.0, None), (0.0, float("nan"))]
    df = spark.createDataFrame(rows, "label double, score double")
    found = m.roc_points(df).orderBy("threshold_no").collect()
    assert len(found) == 100
    for row, edge in zip(found, np.linspace(0, 1, 100)):
        hit = scores >= edge
        assert row["threshold"] == edge
        assert row["tp"] == int((hit & (labels == 1)).sum())
        assert row["fp"] == int((hit & (labels == 0)).sum())
        assert row["tpr"] == pytest.approx(row["tp"] / (labels.sum() + 1))


def test_class_distribution(frame):
    rows = m.class_distribution(frame([(0.0,)] * 3 + [(1.0,)], "label double")).collect()
    assert sorted(r[:] for r in rows) == [(0.0, 3, 75.0), (1.0, 1, 25.0)]


def test_long_forms(frame):
    df = frame([("GBTClassifier", 0.123456, 0.5)],
               "model string, recall_class0 double, accuracy double")
    assert m.recall_long(df).first()[:] == ("GBT", "recall_class0", 0.1235)
    assert m.metrics_long(df).first()[:] == ("GBT", "accuracy", 0.5)


def test_best_model_prefers_values_over_missing(frame):
    df = frame([("a", None), ("c", 0.5), ("b", 0.5)], "model string, f1 double")
    assert m.best_model(df, "f1").first()["model"] == "b"


def test_matrix_accounts_for_every_row(frame):
    cells = frame([(0.0, 0.0, 3), (3.0, 1.0, 5)], CONFUSION_SCHEMA)
    with pytest.raises(Exception, match="not one of 3 classes"):
        m.confusion_matrix(cells, 3).collect()
    rows = m.confusion_matrix(cells, 4).collect()
    assert sum(sum(r[1:]) for r in rows) == 8


def test_exact_auc(spark):
    rng = np.random.default_rng(4)
    scores = np.concatenate([rng.normal(size=3000), np.repeat([0.25, -40.0, 40.0], 50)])
    labels = (rng.random(len(scores)) < 0.3).astype(float)
    rows = list(zip(scores.tolist(), labels.tolist()))
    df = spark.createDataFrame(rows, "rawPrediction double, label double").repartition(5)
    pos, neg = scores[labels == 1], scores[labels == 0]
    won = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert auc_roc(df) == pytest.approx(won / (len(pos) * len(neg)), abs=1e-12)
    assert auc_roc(df.filter("label = 1")) == 0.0 and auc_roc(df.drop("rawPrediction")) == 0.0
