"""Labels, class weights, feature stages, model sets and importances for MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression,
    MultilayerPerceptronClassifier, NaiveBayes, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression, LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import scratch_dir
from ..sources.writers import remove_path
from .features import CATEGORICAL_A, NUMERIC_A

SEED = 42

# --- labels and features ------------------------------------------------------------

# Feature columns that give a target away
LEAKS = {
    "arrest": (),
    "crime_group": ("crime_group", "primary_type_group"),
    "domestic": ("domestic_numeric",),
}


def label_for(df: DataFrame, target: str) -> tuple[DataFrame, bool]:
    """The frame with ``label`` for a target, and whether the target is binary.

    ``arrest`` keeps the label of the feature table, ``domestic`` uses its flag and
    ``crime_group`` numbers the groups, most frequent first.
    """
    if target == "arrest":
        return df, True
    if target == "domestic":
        return df.withColumn("label", F.col("domestic_numeric").cast("double")), True
    if target == "crime_group":
        indexer = StringIndexer(
            inputCol="crime_group", outputCol="label", handleInvalid="keep",
            stringOrderType="frequencyDesc",
        )
        df = df.drop("label")
        return indexer.fit(df).transform(df), False
    raise ValueError(f"unknown target {target!r}; choose from {sorted(LEAKS)}")


def features_for(
    target: str, categorical: Sequence[str] = CATEGORICAL_A, numeric: Sequence[str] = NUMERIC_A
) -> tuple[list[str], list[str]]:
    """Categorical and numeric features of a target without those that reveal it."""
    hidden = LEAKS[target]
    return ([c for c in categorical if c not in hidden], [c for c in numeric if c not in hidden])


def feature_stages(categorical: Sequence[str], numeric: Sequence[str]) -> tuple[list, list[str]]:
    """Indexing and assembly stages and the names of the vector's positions."""
    indexed = [f"{c}_idx" for c in categorical]
    names = [*numeric, *indexed]
    stages = []
    if categorical:
        stages.append(StringIndexer(
            inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep"))
    return stages, names


# --- class weights --------------------------------------------------------------------


def binary_weight(df: DataFrame, label: str = "label") -> Column:
    """Each class weighted with the share of the other one (a one-row subquery)."""
    pos = df.agg(F.count_if(F.col(label) == 1.0) / F.count("*")).scalar()
    return F.when(F.col(label) == 1.0, 1.0 - pos).otherwise(pos)


def balanced_weight(df: DataFrame, k: int, label: str = "label") -> Column:
    """N / (k * rows of the class); a class without rows or beyond k weighs 1."""
    rows = F.count("*").cast("double")
    per_class = [
        F.coalesce(rows / F.nullif(k * F.count_if(F.col(label) == float(i)), F.lit(0)), F.lit(1.0))
        for i in range(k)
    ]
    weights = df.agg(F.array(*per_class)).scalar()
    return F.coalesce(F.get(weights, F.col(label).cast("int")), F.lit(1.0))


def with_class_weights(df: DataFrame, kind: str, k: int = 2, label: str = "label") -> DataFrame:
    if kind not in ("binary", "balanced"):
        raise ValueError(f"unknown weighting {kind!r}; choose binary or balanced")
    weight = binary_weight(df, label) if kind == "binary" else balanced_weight(df, k, label)
    return df.withColumn("classWeight", weight)


# --- model sets -------------------------------------------------------------------------

# The settings of all estimators below

def _classifiers(weighted: bool, binary: bool, forest, gbt) -> dict:
    """The five classifiers of the binary experiment."""
    weight = {"weightCol": "classWeight"} if weighted else {}
    trees, depth = forest
    rounds, gbt_depth, step = gbt
    boosted = GBTClassifier(maxIter=rounds, maxDepth=gbt_depth, stepSize=step, seed=SEED)
    return {
        "LogisticRegression": LogisticRegression(
            maxIter=100, regParam=0.01, elasticNetParam=0.1, **weight),
        "DecisionTreeClassifier": DecisionTreeClassifier(maxDepth=10, seed=SEED, **weight),
        "RandomForestClassifier": RandomForestClassifier(
            numTrees=trees, maxDepth=depth, seed=SEED, **weight),
        # boosted trees know two classes, so more of them go one against the rest
        "GBTClassifier": boosted if binary else OneVsRest(classifier=boosted, parallelism=3),
        "NaiveBayes": NaiveBayes(smoothing=1.0, modelType="multinomial"),
    }


def model_zoo(task: str, features: int = 0) -> dict:
    """Fresh estimators of a task by name.

    Tasks: ``binary``, ``binary_large`` (bigger forest and longer boosting),
    ``multiclass``, ``density`` (regressors) and ``protocol`` (four classes,
    needs the number of features).
    """
    if task == "binary":
        return _classifiers(True, True, (50, 8), (30, 5, 0.1))
    if task == "binary_large":
        return _classifiers(True, True, (100, 10), (100, 6, 0.05))
    if task == "multiclass":
        return _classifiers(False, False, (50, 8), (30, 5, 0.1))
    if task == "density":
        y = {"labelCol": "crime_count"}
        return {
            "LinearRegression": LinearRegression(maxIter=100, regParam=0.01, **y),
            "DecisionTreeRegressor": DecisionTreeRegressor(maxDepth=8, seed=SEED, **y),
            "RandomForestRegressor": RandomForestRegressor(
                numTrees=50, maxDepth=8, seed=SEED, **y),
            "GBTRegressor": GBTRegressor(
                maxIter=30, maxDepth=5, stepSize=0.1, seed=SEED, **y),
            "GeneralizedLinearRegression": GeneralizedLinearRegression(
                family="poisson", link="log", maxIter=50, regParam=0.01, **y),
        }
    if task == "protocol":
        weight = {"weightCol": "classWeight"}
        return {
            "LogisticRegression": LogisticRegression(
                maxIter=200, regParam=0.001, elasticNetParam=0.1, **weight),
            "DecisionTreeClassifier": DecisionTreeClassifier(maxDepth=12, seed=SEED, **weight),
            "RandomForestClassifier": RandomForestClassifier(
                numTrees=50, maxDepth=6, seed=SEED, **weight),
            # the perceptron takes no weights
            "MultilayerPerceptron": MultilayerPerceptronClassifier(
                layers=[features, 32, 4], maxIter=100, seed=SEED),
            "NaiveBayes": NaiveBayes(smoothing=1.0, modelType="multinomial"),
        }
    raise ValueError(f"unknown task {task!r}")


# --- fitted models ------------------------------------------------------------------------


def auc_roc(preds: DataFrame, binary: bool = True) -> float:
    """Exact area under the ROC curve; 0 where it is not defined.

    From counts per score: pairs in the right order plus half of the ties. Scores are numbered
    within ranges of their logistic value, so no task sees all of them.
    """
    if not binary or "rawPrediction" not in preds.columns:
        return 0.0
    raw = F.col("rawPrediction")
    if preds.schema["rawPrediction"].dataType.typeName() != "double":
        raw = vector_to_array(raw).getItem(1)
    ranges = 1024
    counts = preds.select(raw.alias("s"), "label").groupBy("s").agg(
        F.count_if(F.col("label") == 1.0).alias("pos"), F.count_if(F.col("label") != 1.0).alias("neg"),
    ).withColumn("r", F.when(F.isnan("s"), ranges + 1).otherwise(
        F.floor(ranges / (1 + F.exp(-F.col("s"))))))
    upwards = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    # at most ranges + 2 rows
    starts = counts.groupBy("r").agg(F.sum("neg").alias("n")).select(
        "r", F.coalesce(F.sum("n").over(upwards), F.lit(0)).alias("start"))
    inside = Window.partitionBy("r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("start") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    pairs = counts.join(F.broadcast(starts), "r").select("pos", "neg", below.alias("below"))
    area = pairs.agg(
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0)).alias("won"),
        (F.sum("pos").cast("double") * F.sum("neg")).alias("all")).first()
    return area["won"] / area["all"] if area["all"] else 0.0


def _importances(stage) -> list[float] | None:
    if hasattr(stage, "models"):  # one against the rest: the mean over its models
        parts = [_importances(m) for m in stage.models]
        return None if None in parts else [sum(v) / len(v) for v in zip(*parts)]
    if hasattr(stage, "featureImportances"):
        return stage.featureImportances.toArray().tolist()
    # a multinomial regression has a matrix and raises on ``coefficients``
    if getattr(stage, "numClasses", 2) > 2 and hasattr(stage, "coefficientMatrix"):
        return abs(stage.coefficientMatrix.toArray()).mean(axis=0).tolist()
    if hasattr(stage, "coefficients"):
        return abs(stage.coefficients.toArray()).tolist()
    return None


def feature_importance(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """(feature, importance) rows of a fitted model, most important first.

    Tree importances, else absolute coefficients, else zeros.
    """
    stage = model.stages[-1] if isinstance(model, PipelineModel) else model
    values = _importances(stage) or [0.0] * len(names)
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def without_summary(model):
    """A fitted model without its training summary, which is sent to every task with it.

    The summary of a binary model holds the session, and a session that has kept observed metrics or artifacts
    cannot be serialized. A copy drops the summary of most models; the others are written and read again.
    """
    if not getattr(model, "hasSummary", False):
        return model
    bare = model.copy()
    if not bare.hasSummary:
        return bare
    spark = SparkSession.active()
    path = scratch_dir(spark, "model")
    model.write().save(path)
    bare = type(model).load(path)
    remove_path(spark, path)
    return bare


def fit_stages(df: DataFrame, stages: list) -> PipelineModel:
    return Pipeline(stages=stages).fit(df)
