"""Density cube, heatmap and hotspots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.density import density_cube, heatmap, hotspots, patrol_map
from ..operators.explore import profile
from ..schema import CITY_BOX
from .binding import table, typed_incidents, with_incidents


def cube(spark, sf_dir):
    return density_cube(typed_incidents(spark, sf_dir), "date_ts")


def busy_windows(spark, sf_dir):
    """Windows with two incidents or more."""
    return density_cube(typed_incidents(spark, sf_dir), "date_ts", at_least=2)


def cube_profile(spark, sf_dir):
    return profile(cube(spark, sf_dir), ["crime_count"]).select("column", "count", *[
        F.round(c, 6).alias(c) for c in ("mean", "stddev", "min", "max")])


def cells(spark, sf_dir):
    return heatmap(cube(spark, sf_dir)).withColumn("avg_crimes", F.round("avg_crimes", 6))


def patrol(spark, sf_dir):
    found = patrol_map(heatmap(cube(spark, sf_dir)))
    return found.select("lat_grid", "lon_grid_abs", "lon", "time_windows", "cell", *[
        F.round(c, 6).alias(c) for c in ("avg_crimes", "weight", "city_avg")])


def leading_cells(spark, sf_dir):
    # the order is by a mean of counts, so its ties are exact
    found = hotspots(heatmap(cube(spark, sf_dir)), 20)
    return found.select("lat_grid", "lon_grid_abs", "cell", "time_windows",
                        F.round("avg_crimes", 6).alias("avg_crimes"))


def part_supply_density(spark, sf_dir):
    """The same two-level aggregation over deliveries: months per part and mean count."""
    monthly = table(spark, sf_dir, "lineitem").groupBy(
        "l_partkey", "l_suppkey", F.trunc("l_shipdate", "month").alias("month")
    ).agg(F.count("*").alias("n"))
    return monthly.groupBy("l_partkey").agg(
        F.count("*").alias("time_windows"), F.round(F.avg("n"), 6).alias("avg_count"))


_CUBE = """
cube AS (
  SELECT round(lat, 2) AS lat_grid, COALESCE(abs(round(lon, 2)), 0.0) AS lon_grid_abs,
    hour(date_ts) AS hour_of_day, dayofweek(date_ts) + 1 AS day_of_week, month(date_ts) AS month_num,
    CASE WHEN dayofweek(date_ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour(date_ts) >= 22 OR hour(date_ts) <= 5 THEN 1 ELSE 0 END AS is_night,
    count(*) AS crime_count
  FROM inc WHERE lat IS NOT NULL AND round(lat, 2) <> 0.0 AND date_ts IS NOT NULL GROUP BY ALL),
cells AS (
  SELECT lat_grid, lon_grid_abs, count(*) AS time_windows, avg(crime_count) AS avg_crimes
  FROM cube GROUP BY 1, 2),
boxed AS (
  SELECT *, -lon_grid_abs AS lon, printf('%.2fN  %.2fW', lat_grid, lon_grid_abs) AS cell FROM cells
  WHERE lat_grid BETWEEN {0} AND {1} AND -lon_grid_abs BETWEEN {2} AND {3})""".format(*CITY_BOX)

QUERIES = {
    "density_cube": (cube, with_incidents(f"WITH {_CUBE}\nSELECT * FROM cube")),
    "density_cube_at_least": (busy_windows, with_incidents(
        f"WITH {_CUBE}\nSELECT * FROM cube WHERE crime_count >= 2")),
    "density_profile": (cube_profile, with_incidents(f"""
WITH {_CUBE}
SELECT 'crime_count' AS column, count(*)::DOUBLE AS count, round(avg(crime_count), 6) AS mean,
  round(stddev_samp(crime_count), 6) AS stddev, min(crime_count)::DOUBLE AS min,
  max(crime_count)::DOUBLE AS max FROM cube""")),
    "heatmap": (cells, with_incidents(f"""
WITH {_CUBE}
SELECT lat_grid, lon_grid_abs, time_windows, round(avg_crimes, 6) AS avg_crimes FROM cells""")),
    "patrol_map": (patrol, with_incidents(f"""
WITH {_CUBE}
SELECT lat_grid, lon_grid_abs, lon, time_windows, cell, round(avg_crimes, 6) AS avg_crimes,
  round(avg_crimes / (SELECT max(avg_crimes) FROM boxed), 6) AS weight,
  round((SELECT avg(avg_crimes) FROM boxed), 6) AS city_avg FROM boxed""")),
    "hotspots": (leading_cells, with_incidents(f"""
WITH {_CUBE}
SELECT lat_grid, lon_grid_abs, cell, time_windows, round(avg_crimes, 6) AS avg_crimes FROM boxed
ORDER BY boxed.avg_crimes DESC, lat_grid, lon_grid_abs LIMIT 20""")),
    "part_supply_density": (part_supply_density, """
WITH m AS (SELECT l_partkey, l_suppkey, date_trunc('month', l_shipdate) AS month, count(*) AS n
  FROM lineitem GROUP BY ALL)
SELECT l_partkey, count(*) AS time_windows, round(avg(n), 6) AS avg_count FROM m GROUP BY 1"""),
}
