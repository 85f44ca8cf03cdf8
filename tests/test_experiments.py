"""Small training runs: isolation of failures, reports, importances."""

import pytest
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from incidentlake.operators.density import density_cube, heatmap
from incidentlake.operators.features import feature_table
from incidentlake.operators.learning import (
    feature_importance, feature_stages, fit_stages, label_for, model_zoo,
)
from incidentlake.plans.experiments import (
    BINARY_REPORT, ExperimentConfig, run_binary, run_density, run_protocol,
)
from incidentlake.registry.binding import incidents, typed_incidents
from incidentlake.schema import HEATMAP_SCHEMA
from incidentlake.sources import read_report, read_runs


@pytest.fixture(scope="module")
def table_a(spark, sf_dir):
    return feature_table(incidents(spark, sf_dir), "A", keep=["id"]).cache()


def test_binary_run_reports_and_isolates(spark, table_a, tmp_path):
    models = {
        "Broken": NaiveBayes(featuresCol="nothing"),
        "NaiveBayes": NaiveBayes(),
        "Tree": DecisionTreeClassifier(maxDepth=2, weightCol="classWeight"),
    }
    config = ExperimentConfig("arrest", out=str(tmp_path), exp_id="run1", models=models,
                              keys=["id"], keep_models=True)
    result = run_binary(table_a, config)
    assert set(result.failures) == {"Broken"}
    rows = result.metrics.collect()
    assert [r["model"] for r in rows] == ["NaiveBayes", "Tree"]
    assert result.best == max(rows, key=lambda r: r["auc_roc"])["model"]
    assert all(0 <= v <= 1 for r in rows for v in r[1:])
    test_rows = result.confusion.agg(F.sum("count")).first()[0]
    runs = read_runs(spark, config.path("runs"))
    logged = {r["run"]: r["value"] for r in runs.filter("key = 'test_rows'").collect()}
    assert set(logged) == {"Broken", "NaiveBayes", "Tree"} and set(logged.values()) == {str(test_rows)}
    assert runs.filter("key = 'target' and value = 'arrest'").count() == 3
    assert runs.filter("key = 'error'").count() == 1
    schema = "model string, " + ", ".join(f"{c} double" for c in BINARY_REPORT[1:])
    assert read_report(spark, config.path("model_metrics"), schema).count() == 2
    assert (tmp_path / "run1" / "models" / "Tree").is_dir()
    importance = result.importance.collect()
    assert len(importance) == 14
    assert [r["importance"] for r in importance] == sorted(
        (r["importance"] for r in importance), reverse=True)


def test_multiclass_target_picks_by_f1(table_a):
    models = {"NaiveBayes": NaiveBayes(), "Tree": DecisionTreeClassifier(maxDepth=3)}
    result = run_binary(table_a, ExperimentConfig("crime_group", models=models, keys=["id"]))
    rows = result.metrics.collect()
    assert {r["auc_roc"] for r in rows} == {0.0}
    assert result.best == max(rows, key=lambda r: r["f1"])["model"]
    features = {r["feature"] for r in result.importance.collect()}
    assert "crime_group_idx" not in features and "primary_type_group_idx" not in features


def test_all_models_failing(table_a):
    result = run_binary(table_a, ExperimentConfig("arrest", models={
        "Broken": NaiveBayes(featuresCol="nothing")}, keys=["id"]))
    assert result.best is None and result.metrics.count() == 0


def test_density_run(spark, sf_dir, tmp_path):
    models = {"Tree": DecisionTreeRegressor(maxDepth=2, labelCol="crime_count")}
    config = ExperimentConfig("density", out=str(tmp_path), models=models)
    incidents_ = typed_incidents(spark, sf_dir)
    result = run_density(incidents_, config, "date_ts")
    assert result.metrics.first()["rmse"] >= 0 and result.importance.count() == 7
    cells = read_report(spark, config.path("heatmap_data"), HEATMAP_SCHEMA)
    assert sorted(cells.collect()) == sorted(heatmap(density_cube(incidents_, "date_ts")).collect())
    assert heatmap(result.predictions, "prediction").count() > 0


def test_protocol_run(spark, sf_dir):
    df = feature_table(incidents(spark, sf_dir), "C").withColumnRenamed("id", "crime_id")
    models = {"Tree": DecisionTreeClassifier(maxDepth=3, weightCol="classWeight")}
    result = run_protocol(df, ExperimentConfig("protocol", models=models, train_cap=500))
    assert result.metrics.columns[-4:] == [f"recall_class{i}" for i in range(4)]
    assert result.importance.count() == 13


def test_importance_of_a_multinomial_regression(spark, table_a):
    labelled, binary = label_for(table_a, "crime_group")
    assert not binary
    stages, names = feature_stages([], ["hour", "month"])
    model = fit_stages(labelled, [*stages, LogisticRegression(maxIter=2)])
    rows = feature_importance(spark, model, names).collect()
    assert {r["feature"] for r in rows} == {"hour", "month"} and rows[0]["importance"] >= 0
    bayes = fit_stages(labelled, [*stages, NaiveBayes()])
    assert {r["importance"] for r in feature_importance(spark, bayes, names).collect()} == {0.0}


def test_model_sets():
    sizes = {t: len(model_zoo(t, 13)) for t in
             ("binary", "binary_large", "multiclass", "density", "protocol")}
    assert set(sizes.values()) == {5}
    assert model_zoo("multiclass")["GBTClassifier"].__class__.__name__ == "OneVsRest"
    assert model_zoo("protocol", 13)["MultilayerPerceptron"].getLayers() == [13, 32, 4]
    with pytest.raises(ValueError):
        model_zoo("nothing")


def test_layout_does_not_change_models(table_a):
    models = {"Forest": RandomForestClassifier(numTrees=5, maxDepth=4, seed=1, weightCol="classWeight")}
    found = [
        run_binary(table_a.repartition(n), ExperimentConfig("arrest", models=models, keys=["id"], partitions=6)).metrics.first()
        for n in (3, 11)]
    assert found[0] == found[1]


class Counted(DecisionTreeClassifier):
    """Counts its fits; from a depth on it ends the run like a lost driver."""

    fits = []
    fatal = None

    def fit(self, dataset, params=None):
        if Counted.fatal and self.getMaxDepth() >= Counted.fatal:
            raise KeyboardInterrupt
        Counted.fits.append(self.getMaxDepth())
        return super().fit(dataset, params)


def resumable(tmp_path, **settings):
    models = {f"depth {d}": Counted(maxDepth=d, seed=1) for d in (1, 2, 3, 4)}
    return ExperimentConfig("arrest", out=str(tmp_path), models=models, keys=["id"], resume=True, parallelism=1, **settings)


def test_killed_run_is_resumed(spark, table_a, tmp_path, monkeypatch):
    Counted.fits = []
    whole = run_binary(table_a, resumable(tmp_path / "whole"))
    assert Counted.fits == [1, 2, 3, 4] and whole.resumed == []

    Counted.fits = []
    monkeypatch.setattr(Counted, "fatal", 3)
    with pytest.raises(KeyboardInterrupt):
        run_binary(table_a, resumable(tmp_path / "killed"))
    assert Counted.fits == [1, 2]

    monkeypatch.setattr(Counted, "fatal", None)
    config = resumable(tmp_path / "killed")
    result = run_binary(table_a.repartition(3), config)  # another layout is the same input
    assert Counted.fits == [1, 2, 3, 4] and result.resumed == ["depth 1", "depth 2"]
    assert result.metrics.collect() == whole.metrics.collect()
    assert result.best == whole.best and result.confusion.collect() == whole.confusion.collect()
    schema = "model string, " + ", ".join(f"{c} double" for c in BINARY_REPORT[1:])
    reported = read_report(spark, config.path("model_metrics"), schema)
    assert sorted(r["model"] for r in reported.collect()) == sorted(config.models)

    again = run_binary(table_a, resumable(tmp_path / "killed", keep_models=True))
    assert Counted.fits == [1, 2, 3, 4] and len(again.resumed) == 4
    assert {p.name for p in (tmp_path / "killed" / config.name / "models").iterdir()} == set(config.models)
    assert again.metrics.collect() == whole.metrics.collect()


def test_state_is_not_taken_for_other_runs(table_a, tmp_path):
    models = {"NaiveBayes": NaiveBayes()}
    def run(df, **settings):
        return run_binary(df, ExperimentConfig("arrest", **{
            "out": str(tmp_path), "models": models, "keys": ["id"], "resume": True, **settings})).resumed
    assert run(table_a) == []
    assert run(table_a) == ["NaiveBayes"]
    assert run(table_a, seed=7) == []
    assert run(table_a, models={"NaiveBayes": NaiveBayes(smoothing=2.0)}) == []
    assert run(table_a.filter("id % 10 > 0")) == []
    assert run(table_a) == ["NaiveBayes"]
    with pytest.raises(ValueError, match="set out"):
        run(table_a, out=None)


def test_models_of_a_session_with_observed_metrics(spark, frame):
    """Models are sent to tasks without their summary, which holds the session; a used session cannot be serialized."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import Observation

    from incidentlake.operators.learning import without_summary

    seen = Observation()
    rows = frame([(float(k % 2), float(k % 7), float(k % 3 + k % 2)) for k in range(60)], "label double, x double, y double")
    assert rows.observe(seen, F.count(F.lit(1)).alias("n")).count() == 60 and seen.get["n"] == 60
    rows = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(rows)
    for estimator in (LogisticRegression(), RandomForestClassifier(numTrees=3, seed=1)):
        fitted = estimator.fit(rows)
        bare = without_summary(fitted)
        assert fitted.hasSummary and not bare.hasSummary and bare.uid == fitted.uid
        assert bare.transform(rows).groupBy("label", "prediction").count().count() >= 2
        stream = spark._jvm.java.io.ByteArrayOutputStream()
        spark._jvm.java.io.ObjectOutputStream(stream).writeObject(bare._java_obj)
        assert b"SparkSession" not in bytes(stream.toByteArray())
