"""Datasets behind the trend charts and maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import day_name, is_true_loose, month_abbr
from ..schema import CITY_BOX
from .cleaning import in_bbox
from .explore import filter_top_k, frequency, order_by_day, rate_by, top_k
from .sampling import sample_exact

_BUCKETS = {
    "year": F.year,
    "month": F.month,
    "day": F.to_date,
    "hour": F.hour,
    "weekday": day_name,
}


def trend(df: DataFrame, ts: str, by: str) -> DataFrame:
    """Rows per time bucket, in time order; undated rows are left out.

    ``by`` is year, month, day, hour or weekday (Monday first, 0 for absent days).
    """
    if by not in _BUCKETS:
        raise ValueError(f"unknown bucket {by!r}; choose from {sorted(_BUCKETS)}")
    name = "day" if by == "weekday" else by
    counts = frequency(df.select(_BUCKETS[by](F.col(ts)).alias(name)), name, drop_null_keys=True)
    if by == "weekday":
        return order_by_day(counts)
    if by == "month":
        counts = counts.withColumn("month_name", month_abbr("month"))
    return counts.orderBy(name)


def flag_split(df: DataFrame, flag: str) -> DataFrame:
    """Rows with and without a flag, by the loose truth rule."""
    return frequency(df.select(is_true_loose(flag).alias(flag)), flag)


def arrest_rate_by_type(df: DataFrame, k: int = 10) -> DataFrame:
    """Arrest percentage of the k most frequent types against their plain mean."""
    return rate_by(
        df, "primary_type", is_true_loose("arrest"), k=k, mark_above=True
    ).orderBy("rate_pct", "primary_type")


def top_locations(df: DataFrame, k: int = 15) -> DataFrame:
    return top_k(df, "location_description", k, drop_null_keys=True)


def _located(df: DataFrame, box, k: int) -> DataFrame:
    """Located rows of the k most frequent types (of all rows)."""
    return filter_top_k(in_bbox(df, "latitude", "longitude", box), "primary_type", k, among=df)


def map_points(df: DataFrame, n: int, key: str = "crime_id", box=CITY_BOX, k: int = 6) -> DataFrame:
    """Sample of n located rows of the leading types, for a map that cannot draw them all."""
    return sample_exact(_located(df, box, k).select(key, "latitude", "longitude", "primary_type"), key, n)


def map_cells(df: DataFrame, box=CITY_BOX, k: int = 6, digits: int = 2) -> DataFrame:
    """All located rows of the leading types, counted by grid cell and type."""
    return _located(df, box, k).groupBy(
        F.round("latitude", digits).alias("lat_grid"), F.round("longitude", digits).alias("lon_grid"), "primary_type",
    ).agg(F.count("*").alias("count"))
