"""Model experiments: shared feature stages, isolated models, metrics in one job each.

With ``out`` and ``resume`` a run leaves a state folder by a digest of everything a model follows from: the configuration, the
parameters of every estimator, and the counts and key hashes of the training and test rows. A model's state is complete once its scores are
written, after the model itself. A later run with the same digest reads those models and scores and trains only the rest, so a run that
was killed half way ends with the rows it would have had.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..operators.cleaning import fill_missing_numbers
from ..operators.density import CELL, DENSITY_FEATURES, WINDOW, density_cube, heatmap
from ..operators.features import CATEGORICAL_C, NUMERIC_C
from ..operators.learning import (
    auc_roc, feature_importance, feature_stages, features_for, fit_stages, label_for,
    model_zoo, with_class_weights, without_summary,
)
from ..operators.metrics import (
    classification_metrics, confusion, positive_score, regression_metrics, roc_points,
)
from ..operators.sampling import cap_rows, split
from ..sources.runlog import log_run
from ..sources.writers import path_exists, save_model, write_report

TRAIN_CAP = 600_000

# Report columns
BINARY_REPORT = ["model", "accuracy", "f1", "precision", "recall", "auc_roc", "recall_arrested"]
PROTOCOL_REPORT = ["model", "accuracy", "f1", "precision", "recall",
                   "recall_class0", "recall_class1", "recall_class2", "recall_class3"]
DENSITY_REPORT = ["model", "rmse", "mae", "r2"]
# what the metrics read of a model's predictions
_SCORED = ["label", "crime_count", "prediction", "rawPrediction"]

# Experiment names by target, the first three without the name of the source's city
EXPERIMENTS = {
    "arrest": "exp01_arrest_classification",
    "crime_group": "exp02_crime_group",
    "domestic": "exp03_domestic_prediction",
    "density": "exp02_crime_density_regression",
    "protocol": "exp03_dispatch_protocol_classification",
}


@dataclass
class ExperimentConfig:
    """What to train and where results go; without ``out`` nothing is written."""

    target: str = "arrest"
    out: str | None = None
    exp_id: str | None = None
    models: dict | None = None  # default: the task's model set
    keys: list[str] | None = None  # split key; default: the whole row
    train_cap: int | None = TRAIN_CAP  # None trains on everything
    keep_models: bool = False
    resume: bool = False  # keep trained models as state, and take those of an earlier run of the same kind
    partitions: int = 32  # of the training rows, dealt out by the split key at every size
    parallelism: int = 4  # models in training at the same time
    seed: int = 42

    @property
    def name(self) -> str:
        return EXPERIMENTS.get(self.target, f"{self.exp_id}_{self.target}")

    def path(self, part: str) -> str | None:
        return f"{self.out}/{self.exp_id or self.name}/{part}" if self.out else None


@dataclass
class ExperimentResult:
    metrics: DataFrame
    best: str | None
    confusion: DataFrame | None
    importance: DataFrame | None
    predictions: DataFrame | None  # of the best model, lazy
    failures: dict[str, str] = field(default_factory=dict)
    models: dict[str, PipelineModel] = field(default_factory=dict)
    resumed: list[str] = field(default_factory=list)  # models that were read, not trained
    test: DataFrame | None = None  # the rows the models were scored on


@dataclass
class _Task:
    train: DataFrame
    test: DataFrame
    stages: list
    names: list[str]
    columns: list[str]  # next to the vector, what models and metrics need
    models: dict
    score: Callable[[DataFrame], dict]
    report: list[str]
    best_by: str
    classes: bool
    params: dict
    keys: list[str]


def _content(df: DataFrame) -> list[str]:
    """What tells two inputs apart, whatever their layout: rows and sums of two hashes of all columns."""
    hashed = [F.xxhash64(*df.columns), F.xxhash64(F.lit(1), *df.columns)]
    return [str(v) for v in df.agg(F.count("*"), *[F.sum(h.cast("decimal(38,0)")) for h in hashed]).first()]


def _digest(config: ExperimentConfig, task: _Task, estimator) -> str:
    """Of everything a model and its scores follow from, its input apart."""
    parameters = {p.name: str(v) for p, v in estimator.extractParamMap().items()}
    if hasattr(estimator, "getClassifier"):  # a wrapped estimator counts by its parameters, not by its random name
        inner = estimator.getClassifier()
        parameters["classifier"] = [type(inner).__name__, sorted((p.name, str(v)) for p, v in inner.extractParamMap().items())]
    told = [config.target, config.seed, config.partitions, config.train_cap, task.keys, task.names, task.report,
            sorted((k, str(v)) for k, v in task.params.items()), type(estimator).__name__, sorted(parameters.items())]
    return hashlib.md5(json.dumps(told).encode()).hexdigest()


class _State:
    """Trained models and their scores under a digest of configuration and input."""

    def __init__(self, config: ExperimentConfig, task: _Task, spark):
        self.spark, self.report = spark, task.report
        self.root = config.path("state") if config.resume else None
        if config.resume and not config.out:
            raise ValueError("a run is resumed from its folder: set out")
        if self.root:
            content = "|".join(_content(task.train) + _content(task.test))
            self.of = {n: hashlib.md5(f"{content}|{_digest(config, task, e)}".encode()).hexdigest()
                       for n, e in (config.models or task.models).items()}

    def path(self, name: str, part: str) -> str:
        return f"{self.root}/{name}/{self.of[name]}/{part}"

    def read(self, name: str):
        """Scores and model of an earlier run; nothing if they are not complete."""
        if not self.root or not path_exists(self.spark, self.path(name, "scores/_SUCCESS")):
            return None
        row = self.spark.read.parquet(self.path(name, "scores")).first()
        return [row[c] for c in self.report], PipelineModel.load(self.path(name, "model")).stages[-1]

    def write(self, name: str, row: list, model: PipelineModel) -> None:
        if self.root:
            save_model(model, self.path(name, "model"))
            _frame(self.spark, [row], self.report).write.mode("overwrite").parquet(self.path(name, "scores"))


def _run(config: ExperimentConfig, task: _Task) -> ExperimentResult:
    """Train and score every model; a failing one is logged and left out.

    The vectors are built once and kept for all models, a few of which train at the
    same time, and each model is scored from its persisted predictions.
    """
    spark = task.train.sparkSession
    shared = fit_stages(task.train, task.stages)

    def vectors(df):
        return shared.transform(df).select("features", *task.columns).persist(
            StorageLevel.MEMORY_AND_DISK)

    # tree ensembles draw by partition and place, so both follow from the keys alone
    laid_out = task.train.repartition(config.partitions, *task.keys).sortWithinPartitions(*task.keys)
    train, test = vectors(laid_out), vectors(task.test)
    estimators = config.models or task.models
    found, fitted, failures = {}, {}, {}
    state = _State(config, task, spark)
    for name in estimators:
        earlier = state.read(name)
        if earlier:
            found[name], fitted[name] = earlier
    resumed = list(found)

    def attempt(name):
        model = without_summary(estimators[name].fit(train))
        preds = model.transform(test)
        preds = preds.select(*[c for c in _SCORED if c in preds.columns]).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            return model, task.score(preds)
        finally:
            preds.unpersist()

    def finished():
        """Report rows so far, in the order the models are listed."""
        return [found[n] for n in estimators if n in found]

    try:
        params = {
            "target": config.target, "feature_count": len(task.names),
            "train_rows": train.count(), "test_rows": test.count(), **task.params,
        }
        if "classWeight" in task.columns:  # one row per class
            weights = train.groupBy("label").agg(F.max("classWeight")).collect()
            params |= {f"class_weight_{label:g}": w for label, w in sorted(weights)}
        with ThreadPoolExecutor(config.parallelism) as pool:
            started = {pool.submit(inheritable_thread_target(spark)(attempt), n): n
                       for n in estimators if n not in found}
            if config.out and resumed:  # an earlier run may have ended between a model's state and its report
                write_report(_frame(spark, finished(), task.report), config.path("model_metrics"))
                for name in resumed if config.keep_models else []:
                    save_model(PipelineModel([*shared.stages, fitted[name]]), config.path(f"models/{name}"))
            for done in as_completed(started):
                name = started[done]
                try:
                    model, scores = done.result()
                except (KeyboardInterrupt, SystemExit):  # the run ends: models that wait are not trained
                    pool.shutdown(wait=False, cancel_futures=True)
                    raise
                except Exception as error:  # noqa: BLE001 - one bad model must not end the run
                    failures[name] = str(error)
                    _log(spark, config, name, {"model_name": name, **params}, error=error)
                    continue
                found[name] = [name, *[float(scores[c]) for c in task.report[1:]]]
                fitted[name] = model
                state.write(name, found[name], PipelineModel([*shared.stages, model]))
                _log(spark, config, name, {"model_name": name, **params}, scores)
                if config.out:  # appended after every model, so a later crash loses nothing
                    write_report(_frame(spark, [found[name]], task.report), config.path("model_metrics"),
                                 mode="append" if len(found) > 1 else "overwrite")
                    if config.keep_models:
                        save_model(PipelineModel([*shared.stages, model]),
                                   config.path(f"models/{name}"))
    finally:
        train.unpersist()
        test.unpersist()

    rows = finished()
    metrics = _frame(spark, rows, task.report)
    if not rows:
        return ExperimentResult(metrics, None, None, None, None, failures)
    at = task.report.index(task.best_by)
    best = max(rows, key=lambda r: r[at])[0]  # the first of equals, as listed
    models = {n: PipelineModel([*shared.stages, fitted[n]]) for n in estimators if n in fitted}
    predictions = models[best].transform(task.test)
    cells = confusion(predictions).orderBy("label", "prediction") if task.classes else None
    importance = feature_importance(spark, fitted[best], task.names)
    if config.out:
        if cells is not None:
            write_report(cells, config.path("confusion_matrix_best_model"),
                         order_by=("label", "prediction"))
        write_report(importance, config.path("feature_importance_best_model"),
                     order_by=(F.desc("importance"), "feature"))
    return ExperimentResult(
        metrics, best, cells, importance, predictions, failures, models, resumed, task.test)


def roc_curves(result: ExperimentResult, thresholds: int = 100) -> DataFrame:
    """ROC points of every model that gives probabilities, in one aggregation."""
    scored = []
    for name, model in result.models.items():
        preds = model.transform(result.test)
        if "probability" in preds.columns:
            scored.append(preds.select(
                F.lit(name).alias("model"), "label", positive_score().alias("score")))
    return roc_points(reduce(DataFrame.unionByName, scored), thresholds=thresholds, by=["model"])


def _frame(spark, rows, report) -> DataFrame:
    return spark.createDataFrame(
        rows, "model string, " + ", ".join(f"{c} double" for c in report[1:]))


def _log(spark, config, run, params, metrics=None, error=None) -> None:
    if config.out:
        log_run(spark, config.path("runs"), config.name, run, params, metrics, error)


def _scores(one_row: DataFrame) -> dict:
    return one_row.first().asDict()


def run_binary(features: DataFrame, config: ExperimentConfig) -> ExperimentResult:
    """Five classifiers on feature table A for ``arrest``, ``domestic`` or ``crime_group``.

    Best by AUC, or by weighted F1 for the multiclass target, where AUC is undefined.
    """
    df = fill_missing_numbers(
        features.dropna(subset=["label"]),
        ["lat_grid", "lon_grid_abs", "district", "beat", "community_area"])
    keys = config.keys or df.columns
    df, binary = label_for(df, config.target)
    if binary:
        df = with_class_weights(df, "binary")
    train, test = split(df, keys, seed=config.seed)
    stages, names = feature_stages(*features_for(config.target))

    def score(preds):
        found = _scores(classification_metrics(confusion(preds), positive=True))
        found["auc_roc"] = auc_roc(preds, binary)
        if not binary:
            found["recall_arrested"] = 0.0
        return found

    return _run(config, _Task(
        train, test, stages, names, ["label", "classWeight"] if binary else ["label"],
        model_zoo("binary" if binary else "multiclass"), score, BINARY_REPORT,
        "auc_roc" if binary else "f1", True, {"class_balanced": binary}, keys,
    ))


def run_density(
    silver: DataFrame, config: ExperimentConfig, ts: str = "crime_timestamp"
) -> ExperimentResult:
    """Five regressors on the count per cell and time window; best by R2.

    The cube is far smaller than the incidents and feeds the training part, the test
    part and the heatmap, so it is kept while they are built.
    """
    cube = density_cube(silver, ts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, test = split(cube, [*CELL, *WINDOW], seed=config.seed)
        stages, names = feature_stages([], DENSITY_FEATURES)
        result = _run(config, _Task(
            train, test, stages, names, ["crime_count", *CELL], model_zoo("density"),
            lambda preds: _scores(regression_metrics(preds, "crime_count")),
            DENSITY_REPORT, "r2", False, {"target": "crime_count"}, [*CELL, *WINDOW],
        ))
        if config.out:
            write_report(heatmap(cube), config.path("heatmap_data"), parts=None)
        return result
    finally:
        cube.unpersist()


def run_protocol(features: DataFrame, config: ExperimentConfig) -> ExperimentResult:
    """Five classifiers for the four-class label of feature table C; best by weighted F1.

    Training is capped by key hash; the test part is always whole.
    """
    df = with_class_weights(features, "balanced", 4)
    keys = config.keys or ["crime_id"]
    train, test = split(df, keys, seed=config.seed)
    if config.train_cap is not None:
        train = cap_rows(train, keys, config.train_cap, train.count(), config.seed)
    stages, names = feature_stages(CATEGORICAL_C, NUMERIC_C)
    return _run(config, _Task(
        train, test, stages, names, ["label", "classWeight"],
        model_zoo("protocol", len(names)),
        lambda preds: _scores(classification_metrics(confusion(preds), k=4)),
        PROTOCOL_REPORT, "f1", True, {"num_classes": 4, "class_balanced": True}, keys,
    ))
