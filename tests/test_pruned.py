"""Layers by event day: same rows, and scans that read the folders and row groups they need."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from incidentlake.plans.pruned import DAY, on_days, read_days, write_by_day

START = dt.datetime(2026, 5, 1)


@pytest.fixture
def layer(spark):
    n = F.col("id")
    hot = F.when(n % 3 == 0, F.lit(4)).otherwise(n % 10)  # one day holds over a third of all rows
    at = F.when(n % 50 == 49, None).otherwise(F.lit(START) + F.make_dt_interval(hot.cast("int"), (n % 24).cast("int")))
    return spark.range(6000).select("id", at.alias("crime_timestamp"), (n % 7).cast("int").alias("district"), F.md5(n.cast("string")).alias("text"))


def scanned(df):
    """Folders and rows that the scan of the layer has read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    todo, numbers = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan parquet"):
            metrics = node.metrics()
            if metrics.contains("numPartitions"):
                numbers.append((metrics.apply("numPartitions").value(), metrics.apply("numOutputRows").value()))
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return plan, numbers[0]


def test_same_rows_and_static_pruning(spark, layer, tmp_path):
    path = str(tmp_path / "layer")
    write_by_day(layer, path)
    assert sorted(map(str, spark.read.parquet(path).select(*layer.columns).collect())) == sorted(map(str, layer.collect()))
    few = read_days(spark, path, "2026-05-03", "2026-05-04")
    plan, (folders, rows) = scanned(few)
    day = F.to_date("crime_timestamp")
    expected = layer.filter(day.between("2026-05-03", "2026-05-04")).count()
    assert "PartitionFilters: [isnotnull(event_day" in plan and folders == 2 and rows == expected == few.count()
    assert read_days(spark, path).count() == 6000  # rows without a time included


def test_dynamic_pruning_in_a_join(spark, layer, tmp_path):
    path = str(tmp_path / "layer")
    write_by_day(layer, path)
    day = F.to_date("crime_timestamp").alias(DAY)
    layer.groupBy(day).agg(F.count("*").alias("rows")).write.parquet(str(tmp_path / "days"))
    busiest = spark.read.parquet(str(tmp_path / "days")).filter("rows > 1000")
    found = on_days(read_days(spark, path), busiest)
    plan, (folders, rows) = scanned(found)
    assert "dynamicpruning" in plan and folders == 1
    assert {r[0] for r in found.select(DAY).distinct().collect()} == {dt.date(2026, 5, 5)}
    assert rows == found.count() < layer.count()


def test_row_groups_are_sorted_by_district(layer, tmp_path):
    path = str(tmp_path / "layer")
    write_by_day(layer.withColumn("crime_timestamp", F.lit(START)), path, row_group=1024)
    spans = []
    for name in glob.glob(f"{path}/*/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index("district")
        last = None
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            assert last is None or s.min >= last
            last = s.max
            spans.append(s.max - s.min)
    assert len(spans) > 4 and min(spans) == 0


def test_days_are_replaced_alone(spark, layer, tmp_path):
    path = str(tmp_path / "layer")
    write_by_day(layer, path)
    before = {f for f in glob.glob(f"{path}/*/*.parquet")}
    day = F.to_date("crime_timestamp")
    write_by_day(layer.filter(day == "2026-05-02").limit(1), path, days_only=True)
    after = {f for f in glob.glob(f"{path}/*/*.parquet")}
    assert {f.split("/")[-2] for f in before ^ after} == {"event_day=2026-05-02"}
    assert read_days(spark, path, "2026-05-02", "2026-05-02").count() == 1
