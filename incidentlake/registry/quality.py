"""Metric operators on predictions that come from rules instead of trained models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.learning import with_class_weights
from ..operators.metrics import (
    actual_vs_predicted, best_model, class_distribution, classification_metrics, confusion,
    confusion_matrix, metrics_long, per_class, recall_long, regression_metrics,
    residual_histogram, roc_points,
)
from ..operators.features import binary_label, protocol_label
from ..operators.learning import auc_roc
from .binding import incidents, table, with_incidents
from .features import LABEL_SQL

MODELS = ["LogisticRegression", "DecisionTreeClassifier", "MultilayerPerceptron", "GBTRegressor"]


def predictions(spark, sf_dir):
    """Return flags as classes, guessed by four rules named like models."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"array({', '.join(repr(m) for m in MODELS)})[l_orderkey % 4] AS model",
        "CASE l_returnflag WHEN 'A' THEN 0D WHEN 'N' THEN 1D ELSE 2D END AS label",
        "CASE WHEN l_quantity < 10 + l_orderkey % 4 THEN 0D WHEN l_discount < 0.05 THEN 1D ELSE 2D END"
        " AS prediction",
    )


_PREDICTIONS = f"""
p AS (
  SELECT ([{', '.join(repr(m) for m in MODELS)}])[l_orderkey % 4 + 1] AS model,
    CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS DOUBLE) AS label,
    CAST(CASE WHEN l_quantity < 10 + l_orderkey % 4 THEN 0 WHEN l_discount < 0.05::DOUBLE THEN 1 ELSE 2 END
      AS DOUBLE) AS prediction
  FROM lineitem),
cls AS (SELECT range::DOUBLE AS class FROM range(3)),
pc AS (
  SELECT m.model, class, count(*) FILTER (WHERE label = class) AS actual, count(*) FILTER (WHERE prediction = class) AS predicted,
    count(*) FILTER (WHERE label = class AND prediction = class) AS tp
  FROM cls, p AS m WHERE true GROUP BY 1, 2),
rates AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
    CASE WHEN actual > 0 THEN tp / actual ELSE 0 END AS recall FROM pc),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END
  AS f1 FROM rates),
mx AS (
  SELECT model, sum(tp) / sum(actual) AS accuracy, sum(f1 * actual) / sum(actual) AS f1,
    sum(precision * actual) / sum(actual) AS precision, sum(recall * actual) / sum(actual) AS recall,
    max(CASE WHEN class = 0 THEN recall END) AS recall_class0,
    max(CASE WHEN class = 1 THEN recall END) AS recall_class1,
    max(CASE WHEN class = 2 THEN recall END) AS recall_class2,
    max(CASE WHEN class = 1 THEN recall END) AS recall_arrested
  FROM f GROUP BY 1)"""


def _sql(select):
    return f"WITH {_PREDICTIONS}\n{select}"


_SHORT = """trim(replace(replace(replace(replace(model, 'Classifier', ''), 'Regressor', ''),
  'Regression', ' Reg'), 'MultilayerPerceptron', 'MLP'))"""


def _cells(spark, sf_dir):
    return confusion(predictions(spark, sf_dir), by=["model"])


def confusion_counts(spark, sf_dir):
    return _cells(spark, sf_dir)


def dense_confusion(spark, sf_dir):
    return confusion_matrix(_cells(spark, sf_dir), 4, by=["model"])


def class_quality(spark, sf_dir):
    found = per_class(_cells(spark, sf_dir), by=["model"])
    return found.select("model", "class", "actual", "predicted", "tp", *[
        F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


def model_metrics(spark, sf_dir):
    return classification_metrics(_cells(spark, sf_dir), 3, by=["model"], positive=True)


def rounded_metrics(spark, sf_dir):
    found = model_metrics(spark, sf_dir)
    return found.select("model", *[
        F.round(c, 6).alias(c) for c in found.columns if c != "model"])


def metric_rows(spark, sf_dir):
    return metrics_long(model_metrics(spark, sf_dir)).withColumn("value", F.round("value", 6))


def recall_rows(spark, sf_dir):
    return recall_long(model_metrics(spark, sf_dir))


def winner(spark, sf_dir):
    return best_model(model_metrics(spark, sf_dir), "f1").select("model", F.round("f1", 6).alias("f1"))


def _quantities(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_linestatus AS model", "l_quantity AS label", "l_extendedprice / 1500 AS prediction")


_QUANTITIES = """
WITH q AS (SELECT l_linestatus AS model, l_quantity AS label, l_extendedprice / 1500 AS prediction FROM lineitem)"""


def quantity_regression(spark, sf_dir):
    found = regression_metrics(_quantities(spark, sf_dir), by=["model"])
    return found.select("model", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


def residual_bins(spark, sf_dir):
    found = residual_histogram(_quantities(spark, sf_dir), 60)
    return found.select("bin", F.round("lower", 6).alias("lower"),
                        F.round("upper", 6).alias("upper"), "count")


def scatter_points(spark, sf_dir):
    """The points of a scatter chart."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice AS label", "o_totalprice * 2 AS prediction")
    return actual_vs_predicted(rows, "o_orderkey", 2000)


def _scored(spark, sf_dir):
    k = F.from_json("props", "k int")["k"]
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("model"), (k < 15).cast("double").alias("label"),
        (F.col("value") / 500).alias("score"))


def roc(spark, sf_dir):
    found = roc_points(_scored(spark, sf_dir), by=["model"])
    return found.select("model", "threshold_no", "tp", "fp", F.round("tpr", 6).alias("tpr"),
                        F.round("fpr", 6).alias("fpr"))


def area_under_roc(spark, sf_dir):
    """AUC of a coarse score; MLlib's value against the rank formula in SQL."""
    rows = _scored(spark, sf_dir).select(
        "label", F.floor(F.col("score") * 100).cast("double").alias("rawPrediction"))
    return spark.range(1).select(F.round(F.lit(auc_roc(rows)), 6).alias("auc"))


def arrest_distribution(spark, sf_dir):
    df = incidents(spark, sf_dir).select(binary_label("arrest").alias("label"))
    return class_distribution(df).withColumn("pct", F.round("pct", 6))


def _labelled(spark, sf_dir):
    flags = [F.col(c).try_cast("boolean").cast("int") for c in ("domestic", "arrest")]
    return incidents(spark, sf_dir).select(protocol_label(*flags).alias("label"))


def protocol_distribution(spark, sf_dir):
    return class_distribution(_labelled(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


def _weights(df):
    return df.groupBy("label").agg(
        F.count("*").alias("count"), F.round(F.max("classWeight"), 6).alias("class_weight"))


def binary_weights(spark, sf_dir):
    df = incidents(spark, sf_dir).select(binary_label("arrest").alias("label"))
    return _weights(with_class_weights(df, "binary"))


def balanced_weights(spark, sf_dir):
    return _weights(with_class_weights(_labelled(spark, sf_dir), "balanced", 4))


_ARREST = "l AS (SELECT CASE WHEN arrest_b THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM inc)"
_PROTOCOL = f"l AS (SELECT {LABEL_SQL}::DOUBLE AS label FROM inc)"
_DISTRIBUTION = """SELECT label, count(*) AS count,
  round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM l), 6) AS pct FROM l GROUP BY 1"""

QUERIES = {
    "confusion": (confusion_counts, _sql(
        "SELECT model, label, prediction, count(*) AS count FROM p GROUP BY ALL")),
    "confusion_matrix": (dense_confusion, _sql("""
SELECT m.model, range::DOUBLE AS label, count(*) FILTER (WHERE label = range AND prediction = 0) AS pred_0,
  count(*) FILTER (WHERE label = range AND prediction = 1) AS pred_1,
  count(*) FILTER (WHERE label = range AND prediction = 2) AS pred_2, 0 AS pred_3
FROM range(4), p AS m GROUP BY 1, 2""")),
    "class_quality": (class_quality, _sql("""
SELECT model, class, actual, predicted, tp, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f""")),
    "classification_metrics": (rounded_metrics, _sql(
        "SELECT model, " + ", ".join(f"round({c}, 6) AS {c}" for c in (
            "accuracy", "f1", "precision", "recall", "recall_class0", "recall_class1",
            "recall_class2", "recall_arrested")) + " FROM mx")),
    "metrics_long": (metric_rows, _sql("\nUNION ALL\n".join(
        f"SELECT {_SHORT} AS model, '{c}' AS metric, round({c}, 6) AS value FROM mx"
        for c in ("accuracy", "f1", "precision", "recall")))),
    "recall_long": (recall_rows, _sql("\nUNION ALL\n".join(
        f"SELECT {_SHORT} AS model, 'recall_class{i}' AS class, round(recall_class{i}, 4) AS recall FROM mx"
        for i in range(3)))),
    "best_model": (winner, _sql(
        "SELECT model, round(f1, 6) AS f1 FROM mx ORDER BY mx.f1 DESC, model LIMIT 1")),
    "regression_metrics": (quantity_regression, f"""{_QUANTITIES}
SELECT model, round(sqrt(avg((label - prediction) ** 2)), 6) AS rmse,
  round(avg(abs(label - prediction)), 6) AS mae,
  round(1 - sum((label - prediction) ** 2) / (var_pop(label) * count(*)), 6) AS r2 FROM q GROUP BY 1"""),
    "residual_histogram": (residual_bins, f"""{_QUANTITIES},
v AS (SELECT label - prediction AS x FROM q),
r AS (SELECT min(x) AS lo, (max(x) - min(x)) / 60 AS w FROM v),
c AS (SELECT least(CAST(floor((x - lo) / w) AS BIGINT), 59) AS bin, count(*) AS n FROM v, r GROUP BY 1)
SELECT CAST(range AS INT) AS bin, round(lo + range * w, 6) AS lower,
  round(lo + (range + 1) * w, 6) AS upper, COALESCE(n, 0) AS count
FROM range(60) CROSS JOIN r LEFT JOIN c ON c.bin = range"""),
    "actual_vs_predicted": (scatter_points, f"""
SELECT o_orderkey, o_totalprice AS label, o_totalprice * 2 AS prediction FROM orders
ORDER BY (('0x' || substr(md5('42|' || CAST(o_orderkey AS VARCHAR)), 1, 12))::BIGINT % {2**16}),
  md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 2000"""),
    "roc_points": (roc, """
WITH s AS (SELECT event_type AS model, CAST(json_extract_string(props, '$.k') AS INT) < 15 AS hit,
  value / 500 AS score FROM events),
t AS (SELECT CAST(range AS INT) AS threshold_no,
  CASE WHEN range = 99 THEN 1.0::DOUBLE ELSE range * (1.0::DOUBLE / 99) END AS edge FROM range(100)),
c AS (SELECT model, threshold_no, count(*) FILTER (WHERE hit AND score >= edge) AS tp,
  count(*) FILTER (WHERE NOT hit AND score >= edge) AS fp, count(*) FILTER (WHERE hit) AS p, count(*) FILTER (WHERE NOT hit) AS n
  FROM s, t GROUP BY 1, 2)
SELECT model, threshold_no, tp, fp, round(tp / p, 6) AS tpr, round(fp / n, 6) AS fpr FROM c"""),
    "auc_roc": (area_under_roc, """
WITH s AS (SELECT CAST(json_extract_string(props, '$.k') AS INT) < 15 AS hit,
  floor(value / 500 * 100) AS score FROM events),
g AS (SELECT score, count(*) FILTER (WHERE hit) AS p, count(*) FILTER (WHERE NOT hit) AS n FROM s GROUP BY 1),
w AS (SELECT p, n, sum(n) OVER (ORDER BY score) - n AS below FROM g)
SELECT round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 6) AS auc FROM w"""),
    "class_distribution_binary": (arrest_distribution, with_incidents(f"WITH {_ARREST}\n{_DISTRIBUTION}")),
    "class_distribution_protocol": (protocol_distribution, with_incidents(f"WITH {_PROTOCOL}\n{_DISTRIBUTION}")),
    "class_weights_binary": (binary_weights, with_incidents(f"""
WITH {_ARREST}, s AS (SELECT avg(label) AS pos FROM l)
SELECT label, count(*) AS count, round(CASE WHEN label = 1 THEN 1 - pos ELSE pos END, 6) AS class_weight
FROM l, s GROUP BY label, pos""")),
    "class_weights_balanced": (balanced_weights, with_incidents(f"""
WITH {_PROTOCOL}
SELECT label, count(*) AS count,
  round((SELECT count(*) FROM l)::DOUBLE / (4 * count(*)), 6) AS class_weight FROM l GROUP BY 1""")),
}
