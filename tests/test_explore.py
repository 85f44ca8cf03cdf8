"""Exploration, density and sampling against numpy, pandas and brute force."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from incidentlake.operators import density, explore, sampling, trends
from incidentlake.plans.findings import eda_summary


def test_null_groups(frame):
    df = frame([("a",), (None,), ("a",), (None,), ("b",)], "k string")
    counted = {r["k"]: r["count"] for r in explore.frequency(df, "k").collect()}
    assert counted == {"a": 2, None: 2, "b": 1}
    assert explore.frequency(df, "k", drop_null_keys=True).count() == 2
    assert explore.distinct_values(df, ["k"]).first()["distinct_values"] == 3
    assert explore.distinct_values(df, ["k"], include_null=False).first()["distinct_values"] == 2


def test_ties_in_top_k(frame):
    df = frame([(k,) for k in "b a c c d".split()], "k string")
    assert [r[:] for r in explore.top_k(df, "k", 3).collect()] == [("c", 2), ("a", 1), ("b", 1)]
    kept = explore.filter_top_k(df, "k", 2).collect()
    assert sorted(r["k"] for r in kept) == ["a", "c", "c"]


def test_rates_against_the_plain_mean(frame):
    df = frame([("a", 1), ("a", 0), ("b", 1), ("c", 0), (None, 1)], "k string, x int")
    for k in (None, 3):
        rows = explore.rate_by(df, "k", F.col("x") == 1, k=k, mark_above=True).collect()
        assert {r["k"]: r["rate_pct"] for r in rows} == {"a": 50.0, "b": 100.0, "c": 0.0}
        assert {r["mean_pct"] for r in rows} == {50.0}
        assert [r["k"] for r in rows if r["above_mean"]] == ["b"]


def test_share_of_nothing(frame):
    empty = frame([], "x int")
    assert explore.share(empty, F.col("x") == 1).first()[:] == (0, 0, 0.0)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-50, 50, width=16), min_size=1, max_size=30),
       bins=st.integers(1, 9))
def test_histogram_like_numpy(spark, values, bins):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    found = explore.histogram(df, "x", bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins)
    assert sum(r["count"] for r in found) == len(values)
    # a value within rounding of an inner edge may fall on either side
    inner = edges[1:-1]
    if not any(np.isclose(v, e, atol=1e-9) for v in values for e in inner):
        assert [r["count"] for r in found] == list(counts)
    assert [r["lower"] for r in found] == pytest.approx(list(edges[:-1]), abs=1e-9)


def test_correlation_like_pandas(frame):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 3.0), (3.0, 1.0, float("nan")), (4.0, 7.0, 1.0),
            (5.0, 6.0, 2.0)]
    df = frame(rows, "a double, b double, c double")
    expected = pd.DataFrame(rows, columns=list("abc"), dtype=float).corr()
    found = explore.correlation(df, ["a", "b", "c"]).collect()
    assert len(found) == 9
    for r in found:
        assert r["r"] == pytest.approx(expected.loc[r["x"], r["y"]], abs=1e-12)


def test_profile(frame):
    df = frame([(1, 2.0), (2, None), (3, 4.0)], "a int, b double")
    rows = {r["column"]: r for r in explore.profile(df, ["a", "b"], explore.SUMMARY_STATS).collect()}
    assert rows["a"]["mean"] == 2.0 and rows["a"]["50%"] == 2.0 and rows["b"]["count"] == 2.0
    assert rows["b"]["stddev"] == pytest.approx(2 ** 0.5)


def test_days(frame):
    days = [1, 1, 2, 2, 3]
    df = frame([(dt.datetime(2024, 1, d, 4),) for d in days] + [(None,)], "ts timestamp")
    row = explore.busiest_quietest(df, "ts").first()
    assert row[:] == (dt.date(2024, 1, 1), 2, dt.date(2024, 1, 3), 1, pytest.approx(5 / 3))
    week = trends.trend(df, "ts", "weekday").collect()
    assert [(r["day"][:3], r["count"]) for r in week] == [
        ("Mon", 2), ("Tue", 2), ("Wed", 1), ("Thu", 0), ("Fri", 0), ("Sat", 0), ("Sun", 0)]
    grid = explore.weekday_hour_matrix(df, "ts").collect()
    assert len(grid) == 7 and grid[0]["h04"] == 2 and grid[6]["h04"] == 0
    with pytest.raises(ValueError, match="unknown bucket"):
        trends.trend(df, "ts", "century")


def test_summary_of_an_empty_table(frame):
    df = frame([], "date_ts timestamp, primary_type string, district int, location_description string, "
                   "arrest string, domestic string")
    rows = {r["finding"]: r["detail"] for r in eda_summary(df).collect()}
    assert rows["Record count"] == "0 rows"
    assert rows["Busiest calendar day"] == "n/a" and rows["Arrest rate"] == "0.0% (0 incidents)"


def test_cube_and_heatmap(frame):
    at = dt.datetime(2024, 1, 6, 23)
    rows = [(41.881, -87.631, at), (41.879, -87.629, at), (41.881, None, at), (None, -87.6, at),
            (0.001, -87.6, at), (41.881, -87.631, None), (41.881, -87.631, dt.datetime(2024, 2, 6, 6))]
    df = frame(rows, "latitude double, longitude double, crime_timestamp timestamp")
    cube = density.density_cube(df)
    assert sorted(tuple(r) for r in cube.collect()) == sorted([
        (41.88, 87.63, 23, 7, 1, 1, 1, 2), (41.88, 0.0, 23, 7, 1, 1, 1, 1),
        (41.88, 87.63, 6, 3, 2, 0, 0, 1)])
    assert density.density_cube(df, at_least=2).collect() == cube.filter("crime_count >= 2").collect()
    cells = density.heatmap(cube)
    assert cells.agg(F.sum("time_windows")).first()[0] == cube.count()
    assert cells.filter("lon_grid_abs = 87.63").first()[:] == (41.88, 87.63, 2, 1.5)


def test_hotspots(frame):
    cells = frame([(41.88, 87.63, 10, 4.0), (41.9, 87.6, 3, 2.0), (40.0, 87.6, 9, 50.0),
                   (41.7, 87.7, 3, 2.0)],
                  "lat_grid double, lon_grid_abs double, time_windows bigint, avg_crimes double")
    top = density.hotspots(cells, 2).collect()
    assert [r["cell"] for r in top] == ["41.88N  87.63W", "41.70N  87.70W"]
    assert top[0]["weight"] == 1.0 and top[1]["weight"] == 0.5
    assert top[0]["lon"] == -87.63 and top[0]["city_avg"] == pytest.approx(8 / 3)


@pytest.mark.parametrize("offset,limit", [(0, 5), (95, 40), (450, 100), (600, 10)])
def test_deep_pages_by_brute_force(spark, offset, limit):
    # a third of the rows share one day, some have none
    rows = [(i, None if i % 50 == 0 else (9 if i % 3 == 0 else i * 31 % 17)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, at int").repartition(6)
    ordered = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    wanted = [r[0] for r in ordered[offset:offset + limit]]
    page = sampling.newest_records(df, "at", "id", limit, offset)
    assert [r["id"] for r in page.collect()] == wanted
    as_text = df.selectExpr("id", "lpad(cast(at as string), 3, '0') AS at")
    assert [r["id"] for r in sampling.newest_records(as_text, "at", "id", limit, offset).collect()] == wanted


def test_pages_show_chosen_columns(spark):
    df = spark.range(30).selectExpr("id", "id % 7 AS at", "id * 2 AS twice")
    page = sampling.newest_records(df, "at", "id", 3, columns=["twice"])
    assert page.columns == ["twice"] and [r[0] for r in page.collect()] == [12, 26, 40]
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_split_ignores_the_layout(spark):
    df = spark.range(4000).selectExpr("id", "id % 5 AS x")
    train, test = sampling.split(df, ["id"])
    moved, _ = sampling.split(df.repartition(9), ["id"])
    ids = {r["id"] for r in train.collect()}
    assert ids == {r["id"] for r in moved.collect()}
    assert ids.isdisjoint(r["id"] for r in test.collect())
    assert len(ids) + test.count() == 4000 and 3000 < len(ids) < 3400
    other, _ = sampling.split(df, ["id"], seed=7)
    assert ids != {r["id"] for r in other.collect()}


def test_exact_samples(spark):
    df = spark.range(5000)
    assert sampling.sample_exact(df, "id", 77).distinct().count() == 77
    assert sampling.sample_exact(df, "id", 9000).count() == 5000
    assert sampling.sample_exact(df.limit(0), "id", 5).count() == 0


def test_cap(spark):
    df = spark.range(10_000)
    assert sampling.cap_rows(df, ["id"], 10_000, 10_000).count() == 10_000
    assert 2300 < sampling.cap_rows(df, ["id"], 2500, 10_000).count() < 2700


def test_histogram_range_loses_nothing(frame):
    df = frame([(float(x),) for x in (1, 2, 3, 9)], "x double")
    assert sum(r["count"] for r in explore.histogram(df, "x", 4, value_range=(0, 10)).collect()) == 4
    with pytest.raises(Exception, match="outside the range"):
        explore.histogram(df, "x", 4, value_range=(0, 5)).collect()


def test_districts_tie_by_number(frame):
    rows = [(d, dt.datetime(2020, 1, 1 + k, 5)) for k in range(2) for d in (11, 10, 9, 2)]
    df = frame([(d, t, "T", "P", None, None) for d, t in rows],
               "district int, date_ts timestamp, primary_type string, location_description string, arrest string, domestic string")
    found = {r["finding"]: r["detail"] for r in eda_summary(df).collect()}
    assert found["Highest-crime districts"] == "2, 9, 10"


def test_pages_in_a_row_are_the_sorted_table(frame):
    """A cursor walks through ties, equal values and missing ones without a gap."""
    import random
    rng = random.Random(1)
    rows = [(rng.choice([None, "https:a", "https:b", "https:" + "c" * rng.randrange(4)]), i if i != 7 else None) for i in range(200)]
    df = frame(rows, "at string, id int")
    wanted = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))
    wanted = sorted(wanted, key=lambda r: r[0] or "", reverse=True)  # stable; missing values are last
    for limit in (7, 50, 200, 1000):
        cursor, found, pages = None, [], 0
        while True:
            page, cursor = sampling.next_page(df, "at", "id", limit, cursor, ["at", "id"])
            found += [tuple(r) for r in page.collect()]
            pages += 1
            if cursor is None:
                break
        assert found == wanted and pages == 200 // limit + 1
    index = sampling.PageIndex.build(df, "at", "id", ranges=16)
    assert index.rows == 200
    for offset in (0, 3, 60, 150, 199, 200, 500):
        assert [tuple(r) for r in index.page(df, 30, offset).collect()] == wanted[offset:offset + 30]
    assert sampling.PageIndex.build(df.limit(0), "at", "id").page(df.limit(0), 5).count() == 0


def test_pages_reach_the_reader(spark, sf_dir):
    """The range of a cursor and of an indexed page are pushed down."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    index = sampling.PageIndex.build(orders, "o_orderdate", "o_orderkey", ranges=64)
    assert index.rows == orders.count() and len(index.counts) > 30
    plan = index.page(orders, 10, 700, ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan and "o_totalprice" not in plan


def test_absent_weekday(frame):
    from incidentlake.operators.explore import order_by_day
    days = order_by_day(frame([("Monday", 3), ("Sunday", 1)], "day string, count bigint")).collect()
    assert [(r["day"], r["count"]) for r in days][:2] == [("Monday", 3), ("Tuesday", 0)] and len(days) == 7
