"""Model quality from predictions: one aggregation, then arithmetic on few rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import short_model_name
from .explore import best_row, histogram
from .sampling import sample_exact


def confusion(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (label, prediction), per group of ``by`` such as a model name."""
    return preds.groupBy(*by, "label", "prediction").agg(F.count("*").alias("count"))


def confusion_matrix(cells: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Dense k x k matrix from confusion rows, one row per true class, zeros included.

    A label or prediction that is not one of ``0 .. k-1`` is an error: no row is left out.
    """
    def at(i, j):
        here = (F.col("label") == float(i)) & (F.col("prediction") == float(j))
        return F.coalesce(F.sum(F.when(here, F.col("count"))), F.lit(0))

    rows = F.array(*[
        F.struct(F.lit(float(i)).alias("label"), *[at(i, j).alias(f"pred_{j}") for j in range(k)])
        for i in range(k)
    ])
    classes = [float(i) for i in range(k)]
    known = F.col("label").isin(classes) & F.col("prediction").isin(classes)
    beyond = F.count_if(~F.coalesce(known, F.lit(False)))
    checked = F.when(beyond > 0, F.raise_error(F.lit(f"a label or prediction is not one of {k} classes"))).otherwise(rows)
    return (
        cells.groupBy(*by).agg(checked.alias("r"))
        .select(*by, F.explode("r").alias("r")).select(*by, "r.*")
    )


def _ratio(a, b) -> Column:
    """a/b, and 0 where b is 0."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(b > 0, a / b).otherwise(0.0)


def per_class(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Hits, actual and predicted rows, precision, recall and F1 of every class."""
    n, hit = F.col("count"), F.col("label") == F.col("prediction")
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("label").alias("class"), n.alias("actual"), zero.alias("predicted"),
                 F.when(hit, n).otherwise(zero).alias("tp")),
        F.struct(F.col("prediction").alias("class"), zero.alias("actual"),
                 n.alias("predicted"), zero.alias("tp")),
    )
    totals = (
        cells.select(*by, F.explode(sides).alias("s")).select(*by, "s.*")
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "tp")])
    )
    rates = totals.withColumns({
        "precision": _ratio("tp", "predicted"), "recall": _ratio("tp", "actual"),
    })
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", _ratio(2 * p * r, p + r))


def classification_metrics(
    cells: DataFrame, k: int = 0, by: Sequence[str] = (), positive: bool = False
) -> DataFrame:
    """Accuracy, weighted F1, precision and recall from confusion rows.

    ``k`` adds ``recall_class0 .. k-1``; ``positive`` adds the recall of class 1.
    """
    def weighted(c):
        return _ratio(F.sum(F.col(c) * F.col("actual")), F.sum("actual")).alias(c)

    def recall_of(i):
        mine = F.max(F.when(F.col("class") == float(i), F.col("recall")))
        return F.coalesce(mine, F.lit(0.0))

    extra = [recall_of(i).alias(f"recall_class{i}") for i in range(k)]
    if positive:
        extra.append(recall_of(1).alias("recall_arrested"))
    return per_class(cells, by).groupBy(*by).agg(
        _ratio(F.sum("tp"), F.sum("actual")).alias("accuracy"),
        weighted("f1"), weighted("precision"), weighted("recall"), *extra,
    )


def regression_metrics(
    preds: DataFrame, label: str = "label", prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """RMSE, MAE and R2 in one aggregation."""
    y, e = F.col(label), F.col(label) - F.col(prediction)
    spread = F.var_pop(y) * F.count("*")
    return preds.groupBy(*by).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - F.sum(e * e) / F.nullif(spread, F.lit(0.0))).alias("r2"),
    )


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and percentage per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("count"))
    # a handful of classes, so one partition is enough for the total
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("pct", 100.0 * F.col("count") / total)


def positive_score(probability: str = "probability") -> Column:
    """Probability of class 1 out of the probability vector."""
    return vector_to_array(F.col(probability)).getItem(1)


def roc_points(
    preds: DataFrame, score: Column | str = "score", label: str = "label",
    thresholds: int = 100, by: Sequence[str] = (),
) -> DataFrame:
    """True and false positive rates for ``score >= t`` at evenly spaced t in [0, 1].

    Each score is reduced to the number of thresholds it reaches, so the data is
    aggregated to at most ``thresholds + 1`` rows per group before the running sums.
    """
    s = F.col(score) if isinstance(score, str) else score
    steps = thresholds - 1

    def edge(i):
        return F.when(i == steps, 1.0).otherwise(i * F.lit(1.0 / steps))

    # an unknown score reaches no threshold
    s = F.when(F.isnan(s), -1.0).otherwise(F.coalesce(s, F.lit(-1.0)))
    guess = F.floor(s * steps)
    # repair the guess where the product rounds across an edge
    level = (
        F.when(edge(guess + 1) <= s, guess + 1).when(edge(guess) > s, guess - 1)
        .otherwise(guess)
    )
    level = F.greatest(F.least(level, F.lit(steps)), F.lit(-1)).cast("int")
    reached = (
        preds.select(*by, level.alias("level"), (F.col(label) == 1.0).alias("hit"))
        .groupBy(*by, "level").agg(
            F.count_if("hit").alias("tp"), F.count_if(~F.col("hit")).alias("fp"),
        )
    )
    levels = F.sequence(F.lit(-1), F.lit(steps))
    cells = F.map_from_entries(F.collect_list(F.struct("level", F.struct("tp", "fp"))))
    dense = reached.groupBy(*by).agg(cells.alias("m")).select(
        *by, F.explode(levels).alias("level"), "m"
    ).select(*by, "level", *[
        F.coalesce(F.try_element_at("m", F.col("level"))[c], F.lit(0)).alias(c)
        for c in ("tp", "fp")
    ])
    down = Window.partitionBy(*by).orderBy(F.desc("level")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(*by)
    return dense.select(
        *by, "level",
        *[F.sum(c).over(down).alias(c) for c in ("tp", "fp")],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in ("tp", "fp")],
    ).filter("level >= 0").select(
        *by, F.col("level").alias("threshold_no"), edge(F.col("level")).alias("threshold"),
        "tp", "fp", _ratio("tp", "tp_all").alias("tpr"), _ratio("fp", "fp_all").alias("fpr"),
    )


def residual_histogram(preds: DataFrame, bins: int = 60, by: Sequence[str] = ()) -> DataFrame:
    """Histogram of label minus prediction."""
    return histogram(preds, F.col("label") - F.col("prediction"), bins, by=by)


def actual_vs_predicted(preds: DataFrame, key: str, n: int) -> DataFrame:
    """n real (label, prediction) points for a scatter chart."""
    return sample_exact(preds.select(key, "label", "prediction"), key, n)


def metrics_long(
    metrics: DataFrame,
    columns: Sequence[str] = ("accuracy", "f1", "precision", "recall", "auc_roc"),
) -> DataFrame:
    """(model, metric, value) rows with short model names."""
    kept = [c for c in columns if c in metrics.columns]
    return metrics.select(short_model_name("model").alias("model"), *kept).unpivot(
        "model", kept, "metric", "value")


def recall_long(metrics: DataFrame) -> DataFrame:
    """(model, class, recall) rows, recall to four decimals."""
    recalls = [c for c in metrics.columns if c.startswith("recall_class")]
    return metrics.select(short_model_name("model").alias("model"), *recalls).unpivot(
        "model", recalls, "class", "recall").withColumn("recall", F.round("recall", 4))


def best_model(metrics: DataFrame, measure: str) -> DataFrame:
    return best_row(metrics, measure, "model")
