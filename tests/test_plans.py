"""Plan shapes that matter at scale, and independence from ANSI mode."""

import pytest

from incidentlake.operators.density import density_cube
from incidentlake.operators.features import feature_table
from incidentlake.operators.trends import arrest_rate_by_type
from incidentlake.plans.layers import to_silver
from incidentlake.registry.binding import bronze_rows, incidents
from incidentlake.streaming import decode_envelope, parse_events


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    bronze, silver = str(root / "bronze"), str(root / "silver")
    bronze_rows(spark, sf_dir).write.parquet(bronze)
    to_silver(spark.read.parquet(bronze)).write.parquet(silver)
    return spark.read.parquet(bronze), spark.read.parquet(silver)


def test_dedupe_limits_every_key_before_the_shuffle(stored):
    plan = plan_of(to_silver(stored[0]))
    assert plan.count("Exchange") == 1
    before = plan[plan.index("Exchange"):]  # below the exchange in the printed tree
    assert "WindowGroupLimit" in before and "Partial" in before
    assert "IsNotNull(crime_id)" in plan and "IsNotNull(primary_type)" in plan


def test_feature_table_is_one_narrow_scan(stored):
    plan = plan_of(feature_table(stored[1], "A"))
    assert "Exchange" not in plan
    assert "IsNotNull(district)" in plan and "IsNotNull(crime_timestamp)" in plan
    assert "description:" not in plan.replace("location_description:", "")


def test_cube_reads_three_columns(stored):
    plan = plan_of(density_cube(stored[1]))
    assert "ReadSchema: struct<latitude:double,longitude:double,crime_timestamp:timestamp>" in plan
    assert plan.count("Exchange") == 1


def test_rates_take_one_scan(stored):
    plan = plan_of(arrest_rate_by_type(stored[1]))
    assert plan.count("FileScan") == 1 and "TakeOrderedAndProject" in plan


def test_silver_straight_from_messages_plans_quickly(spark, frame):
    empty = frame([], "key binary, value binary, timestamp timestamp")
    plan = plan_of(to_silver(parse_events(decode_envelope(empty))))
    assert plan


@pytest.mark.parametrize("variant", ["A", "B", "C"])
def test_ansi_mode_changes_nothing(spark, sf_dir, variant):
    found = []
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            rows = feature_table(incidents(spark, sf_dir), variant).drop("ts").collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
        found.append(sorted(map(str, rows)))
    assert found[0] == found[1]
