"""Every registered query with SQL agrees with DuckDB, and its plan stays in the JVM."""

import pytest

from __spark_entry__ import entry
from incidentlake.registry import collect
from tools.compare import connect, differences

QUERIES = {name: query for name, (query, _) in collect().items()}
SQL = {name: sql for name, (_, sql) in collect().items() if sql is not None}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, sf_dir, name):
    found, _ = differences(QUERIES[name](spark, sf_dir), duck, SQL[name])
    assert not found


def test_only_trained_models_go_without_sql():
    assert set(QUERIES) - set(SQL) == {
        "experiment_arrest", "experiment_domestic", "experiment_crime_group",
        "experiment_density", "experiment_protocol"}


def test_flagship(spark, sf_dir):
    assert entry(spark).count() == 10


PLANNED = [
    "silver_table", "gold_table", "feature_table_a", "feature_table_b", "feature_table_c",
    "bronze_parse", "eda_summary", "density_cube", "patrol_map", "map_points", "roc_points",
    "classification_metrics", "dedupe_lines", "value_histogram", "weekday_hour_matrix",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_plans_have_no_python_and_no_products(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
