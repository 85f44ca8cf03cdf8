"""Feature stages, labels and trained models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Window, functions as F

from ..operators.density import density_cube, heatmap
from ..operators.features import CATEGORICAL_A, feature_table
from ..operators.learning import (
    feature_stages, features_for, fit_stages, label_for, model_zoo,
)
from ..operators.metrics import confusion
from ..plans.experiments import (
    ExperimentConfig, roc_curves, run_binary, run_density, run_protocol,
)
from ..session import scratch_dir
from ..schema import HEATMAP_SCHEMA
from ..sources import read_report, read_runs, save_model
from .binding import incidents, table, typed_incidents, with_incidents
from .density import _CUBE
from .features import FEATURES_A_SQL


def _table_a(spark, sf_dir):
    return feature_table(incidents(spark, sf_dir), "A", keep=["id"])


def category_indexes(spark, sf_dir):
    """Indexes by frequency, ties by name."""
    df = _table_a(spark, sf_dir)
    stages, _ = feature_stages(CATEGORICAL_A, [])
    indexed = fit_stages(df, stages).transform(df)
    parts = [
        indexed.select(F.lit(c).alias("column"), F.col(c).alias("value"),
                       F.col(f"{c}_idx").alias("position")) for c in CATEGORICAL_A
    ]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return stacked.groupBy("column", "value", "position").agg(F.count("*").alias("count"))


def feature_vectors(spark, sf_dir):
    """Assembled vectors, summed up by position."""
    df = _table_a(spark, sf_dir)
    categorical, numeric = features_for("arrest")
    stages, names = feature_stages(categorical, numeric)
    vectors = fit_stages(df, stages).transform(df)
    parts = vectors.select(F.posexplode(vector_to_array("features")).alias("i", "x"))
    named = parts.withColumn("feature", F.get(F.array(*[F.lit(n) for n in names]), F.col("i")))
    # cents keep the sum exact, whatever the order of addition
    return named.groupBy("feature").agg(F.sum(F.round(F.col("x") * 100).cast("bigint")).alias("total"))


def group_labels(spark, sf_dir):
    labelled, _ = label_for(_table_a(spark, sf_dir), "crime_group")
    return labelled.groupBy("crime_group", "label").agg(F.count("*").alias("count"))


NB_FEATURES = ["hour", "day_of_week", "month", "is_night", "domestic_numeric", "district", "beat"]


def naive_bayes(spark, sf_dir):
    """Multinomial naive Bayes, trained and applied on the whole feature table."""
    df = _table_a(spark, sf_dir)
    stages, _ = feature_stages([], NB_FEATURES)
    model = fit_stages(df, [*stages, NaiveBayes(smoothing=1.0, modelType="multinomial")])
    return confusion(model.transform(df))


def _naive_bayes_sql():
    sums = ", ".join(f"sum({c}) AS s_{c}" for c in NB_FEATURES)
    total = " + ".join(f"s_{c}" for c in NB_FEATURES)
    k = len(NB_FEATURES)
    score = " + ".join(
        f"a.{c} * (ln(s_{c} + 1.0::DOUBLE) - ln({total} + {k}.0::DOUBLE))" for c in NB_FEATURES)
    return f"""
, c AS (SELECT label AS cls, count(*) AS n, {sums} FROM a GROUP BY 1),
s AS (SELECT a.id, a.label, c.cls,
  ln(n + 1.0::DOUBLE) - ln((SELECT count(*) FROM a) + 2.0::DOUBLE) + {score} AS score FROM a, c),
b AS (SELECT label, arg_max(cls, score) AS prediction FROM s GROUP BY id, label)
SELECT label, prediction, count(*) AS count FROM b GROUP BY ALL"""


def with_table_a(rest: str) -> str:
    """SQL over ``a``, feature table A with its id."""
    head, body = FEATURES_A_SQL.rsplit("inc AS (SELECT *, COALESCE(iso_ts, us_ts) AS date_ts FROM iso)", 1)
    return f"{head}inc AS (SELECT *, COALESCE(iso_ts, us_ts) AS date_ts FROM iso),\na AS ({body})\n{rest}"


def linear_fit(spark, sf_dir):
    """Unregularised linear regression of price on quantity."""
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    stages, _ = feature_stages([], ["l_quantity"])
    fitted = fit_stages(lines, [*stages, LinearRegression(labelCol="l_extendedprice", maxIter=100)])
    line = fitted.stages[-1]
    return spark.range(1).select(
        F.round(F.lit(float(line.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(line.intercept)), 4).alias("intercept"))


def saved_model(spark, sf_dir):
    """Predictions by class of a model that was stored and read again, and how many differ from the fitted one's."""
    df = _table_a(spark, sf_dir)
    stages, _ = feature_stages([], NB_FEATURES)
    model = fit_stages(df, [*stages, NaiveBayes(smoothing=1.0, modelType="multinomial")])
    path = scratch_dir(spark, "model")
    save_model(model, path)
    before = model.transform(df).select(*df.columns, F.col("prediction").alias("before"))
    return PipelineModel.load(path).transform(before).groupBy("label", "prediction").agg(
        F.count("*").alias("count"), F.count_if(F.col("before") != F.col("prediction")).alias("changed"))


# --- experiments: trained on the whole tables, rows-only checks ------------------------

#: Parts of the training rows here; on a cluster, as many as the training tasks should be.
PARTS = 8


def _whole(result):
    """The result of an experiment whose models have all been trained."""
    if result.failures:
        raise RuntimeError(f"models that failed: {result.failures}")
    return result


def _experiment(target):
    def query(spark, sf_dir):
        return _whole(run_binary(_table_a(spark, sf_dir), ExperimentConfig(target, keys=["id"], partitions=PARTS))).metrics
    return query


def model_roc_curves(spark, sf_dir):
    """ROC points of all five models; both ends of every curve are checked in SQL."""
    result = _whole(run_binary(_table_a(spark, sf_dir), ExperimentConfig("arrest", keys=["id"], partitions=PARTS)))
    points = roc_curves(result)
    rising = Window.partitionBy("model").orderBy(F.desc("threshold_no"))
    before = F.coalesce(F.lag("tpr").over(rising), F.lit(0.0))
    return points.withColumn("step", F.col("tpr") - before).groupBy("model").agg(
        F.count("*").alias("points"), F.max("tpr").alias("top"),
        F.count_if(F.col("step") < 0).alias("falling"))


def density_experiment(spark, sf_dir):
    return _whole(run_density(typed_incidents(spark, sf_dir), ExperimentConfig("density", partitions=PARTS), "date_ts")).metrics


def predicted_heatmap(spark, sf_dir):
    """Cells of the heatmap of predicted counts: every window of the cube is predicted."""
    boosted = {"GBTRegressor": model_zoo("density")["GBTRegressor"]}
    incidents_ = typed_incidents(spark, sf_dir)
    result = _whole(run_density(incidents_, ExperimentConfig("density", models=boosted, partitions=PARTS), "date_ts"))
    predicted = result.models[result.best].transform(density_cube(incidents_, "date_ts"))
    found = heatmap(predicted, "prediction")
    return found.select("lat_grid", "lon_grid_abs", "time_windows")


def importance_of_a_tree(spark, sf_dir):
    """Features of the best model, whose importances add up to one."""
    models = {"DecisionTreeClassifier": model_zoo("binary")["DecisionTreeClassifier"]}
    result = _whole(run_binary(_table_a(spark, sf_dir), ExperimentConfig("arrest", models=models, keys=["id"], partitions=PARTS)))
    total = F.round(F.sum("importance").over(Window.partitionBy()), 6)
    return result.importance.select("feature", total.alias("total"))


def heatmap_report(spark, sf_dir):
    """The heatmap file that the density experiment leaves behind."""
    out = scratch_dir(spark, "density")
    models = {"LinearRegression": model_zoo("density")["LinearRegression"]}
    config = ExperimentConfig("density", out=out, models=models)
    run_density(typed_incidents(spark, sf_dir), config, "date_ts")
    cells = read_report(spark, config.path("heatmap_data"), HEATMAP_SCHEMA)
    return cells.withColumn("avg_crimes", F.round("avg_crimes", 6))


def protocol_experiment(spark, sf_dir):
    table_c = feature_table(incidents(spark, sf_dir), "C").withColumnRenamed("id", "crime_id")
    return _whole(run_protocol(table_c, ExperimentConfig("protocol", partitions=PARTS))).metrics


def experiment_reports(spark, sf_dir):
    """What an experiment leaves behind: its run log, with a failing model among it."""
    out = scratch_dir(spark, "reports")
    models = {"NaiveBayes": NaiveBayes(), "Broken": NaiveBayes(featuresCol="no_such_column")}
    config = ExperimentConfig("arrest", out=out, models=models, keys=["id"])
    run_binary(_table_a(spark, sf_dir), config)
    runs = read_runs(spark, config.path("runs"))
    return runs.groupBy("experiment", "run").agg(
        F.count_if(F.col("kind") == "metric").alias("metrics"),
        F.count_if(F.col("key") == "error").alias("errors"))


_IDX = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, {c} AS value, "
    f"(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1)::DOUBLE AS position, count(*) AS count "
    f"FROM a GROUP BY {c}" for c in CATEGORICAL_A)

_NUMERIC = ["hour", "day_of_week", "month", "is_weekend", "is_night", "domestic_numeric",
            "district", "beat", "community_area", "lat_grid", "lon_grid_abs"]
_VECTORS = "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS feature, sum(CAST(round({c} * 100) AS BIGINT))::BIGINT AS total FROM a"
     for c in _NUMERIC]
    + [f"SELECT '{c}_idx', sum(position * count * 100)::BIGINT FROM i WHERE \"column\" = '{c}'"
       for c in CATEGORICAL_A])

QUERIES = {
    "category_indexes": (category_indexes, with_table_a(_IDX)),
    "feature_vectors": (feature_vectors, with_table_a(f", i AS ({_IDX})\n{_VECTORS}")),
    "crime_group_labels": (group_labels, with_table_a("""
SELECT crime_group, (row_number() OVER (ORDER BY count(*) DESC, crime_group) - 1)::DOUBLE AS label,
  count(*) AS count FROM a GROUP BY 1""")),
    "naive_bayes": (naive_bayes, with_table_a(_naive_bayes_sql())),
    "linear_regression": (linear_fit, """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem"""),
    "saved_model": (saved_model, with_table_a(_naive_bayes_sql().replace("AS count FROM b", "AS count, 0 AS changed FROM b"))),
    "experiment_reports": (experiment_reports, """
SELECT 'exp01_arrest_classification' AS experiment, 'NaiveBayes' AS run, 6 AS metrics, 0 AS errors
UNION ALL SELECT 'exp01_arrest_classification', 'Broken', 0, 1"""),
    "model_roc_curves": (model_roc_curves, """
SELECT unnest(['LogisticRegression', 'DecisionTreeClassifier', 'RandomForestClassifier', 'GBTClassifier',
  'NaiveBayes']) AS model, 100 AS points, 1.0::DOUBLE AS top, 0 AS falling"""),
    "feature_importance": (importance_of_a_tree, f"""
SELECT unnest({[*_NUMERIC, *[f"{c}_idx" for c in CATEGORICAL_A]]}) AS feature, 1.0::DOUBLE AS total"""),
    "heatmap_report": (heatmap_report, with_incidents(f"""
WITH {_CUBE}
SELECT lat_grid, lon_grid_abs, time_windows, round(avg_crimes, 6) AS avg_crimes FROM cells""")),
    "experiment_arrest": (_experiment("arrest"), None),
    "experiment_domestic": (_experiment("domestic"), None),
    "experiment_crime_group": (_experiment("crime_group"), None),
    "experiment_density": (density_experiment, None),
    "predicted_heatmap": (predicted_heatmap, with_incidents(
        f"WITH {_CUBE}\nSELECT lat_grid, lon_grid_abs, time_windows FROM cells")),
    "experiment_protocol": (protocol_experiment, None),
}
