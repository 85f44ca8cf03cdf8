"""Trend, split and map datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import is_true_loose
from ..operators.cleaning import in_bbox
from ..operators.explore import filter_top_k
from ..operators.trends import (
    arrest_rate_by_type, flag_split, map_cells, map_points, top_locations, trend,
)
from ..schema import CITY_BOX
from .binding import typed_incidents, with_incidents
from .tables import hash_part_sql


# fewer than match at any of the scales, so sampling is really exercised
MAP_POINTS = 300


def _trend(by):
    def query(spark, sf_dir):
        df = trend(typed_incidents(spark, sf_dir), "date_ts", by)
        return df.withColumn("day", F.col("day").cast("string")) if by == "day" else df
    return query


def _trend_sql(column):
    return with_incidents(
        f"SELECT {column}, count(*) AS count FROM inc WHERE date_ts IS NOT NULL GROUP BY ALL")


def arrest_rates(spark, sf_dir):
    found = arrest_rate_by_type(typed_incidents(spark, sf_dir))
    return found.select(
        "primary_type", "count", F.round("rate_pct", 6).alias("rate_pct"),
        F.round("mean_pct", 6).alias("mean_pct"), "above_mean")


def _flag_split(name):
    return lambda spark, sf_dir: flag_split(typed_incidents(spark, sf_dir), name)


def locations(spark, sf_dir):
    return top_locations(typed_incidents(spark, sf_dir), 15)


def map_point_sample(spark, sf_dir):
    """The sampled points themselves."""
    return map_points(typed_incidents(spark, sf_dir), MAP_POINTS, key="id")


def map_grid(spark, sf_dir):
    """All located rows of the leading types, counted by cell."""
    return map_cells(typed_incidents(spark, sf_dir))


def map_point_counts(spark, sf_dir):
    """Located rows of the leading types before sampling."""
    df = typed_incidents(spark, sf_dir)
    inside = filter_top_k(in_bbox(df, "latitude", "longitude"), "primary_type", 6, among=df)
    return inside.groupBy("primary_type").agg(
        F.count("*").alias("count"), F.count_if(is_true_loose("arrest")).alias("arrests"))


_IN_BOX = (f"lat BETWEEN {CITY_BOX[0]} AND {CITY_BOX[1]} "
           f"AND lon BETWEEN {CITY_BOX[2]} AND {CITY_BOX[3]}")
_TOP6 = "t AS (SELECT primary_type AS p FROM inc GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 6)"

QUERIES = {
    "trend_yearly": (_trend("year"), _trend_sql("year(date_ts) AS year")),
    "trend_monthly": (_trend("month"), _trend_sql(
        "month(date_ts) AS month, strftime(date_ts, '%b') AS month_name")),
    "trend_daily": (_trend("day"), _trend_sql("strftime(date_ts, '%Y-%m-%d') AS day")),
    "trend_hourly": (_trend("hour"), _trend_sql("hour(date_ts) AS hour")),
    "trend_weekday": (_trend("weekday"), with_incidents("""
WITH days AS (SELECT * FROM (VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'),
  (4, 'Thursday'), (5, 'Friday'), (6, 'Saturday'), (7, 'Sunday')) t(position, day))
SELECT position, day, count(id) AS count FROM days LEFT JOIN inc ON dayname(date_ts) = day GROUP BY ALL""")),
    "arrest_rate_by_type": (arrest_rates, with_incidents("""
WITH g AS (SELECT primary_type, count(*) AS count,
  100 * avg(CASE WHEN arrest_loose THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS r
  FROM inc WHERE primary_type IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
SELECT primary_type, count, round(r, 6) AS rate_pct, round((SELECT avg(r) FROM g), 6) AS mean_pct,
  r > (SELECT avg(r) FROM g) AS above_mean FROM g""")),
    "arrest_split": (_flag_split("arrest"), with_incidents(
        "SELECT arrest_loose AS arrest, count(*) AS count FROM inc GROUP BY 1")),
    "domestic_split": (_flag_split("domestic"), with_incidents(
        "SELECT COALESCE(lower(domestic) IN ('true', '1'), false) AS domestic, count(*) AS count "
        "FROM inc GROUP BY 1")),
    "top_locations": (locations, with_incidents("""
SELECT location_description, count(*) AS count FROM inc WHERE location_description IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")),
    "map_points": (map_point_sample, with_incidents(f"""
WITH {_TOP6}
SELECT id, lat AS latitude, lon AS longitude, primary_type FROM inc
WHERE {_IN_BOX} AND primary_type IN (SELECT p FROM t)
ORDER BY {hash_part_sql("id", 42, 2**16)}, md5('42|' || id), id LIMIT {MAP_POINTS}""")),
    "map_cells": (map_grid, with_incidents(f"""
WITH {_TOP6}
SELECT round(lat, 2) AS lat_grid, round(lon, 2) AS lon_grid, primary_type, count(*) AS count FROM inc
WHERE {_IN_BOX} AND primary_type IN (SELECT p FROM t) GROUP BY 1, 2, 3""")),
    "map_point_counts": (map_point_counts, with_incidents(f"""
WITH {_TOP6}
SELECT primary_type, count(*) AS count, count(*) FILTER (WHERE arrest_loose) AS arrests FROM inc
WHERE {_IN_BOX} AND primary_type IN (SELECT p FROM t) GROUP BY 1""")),
}
