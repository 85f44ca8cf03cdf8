"""Counts per grid cell and time window, heatmaps and hotspots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import cell_label
from ..schema import CITY_BOX
from .cleaning import in_bbox
from .features import geo_grid, night_flag, weekend_flag

CELL = ["lat_grid", "lon_grid_abs"]
WINDOW = ["hour_of_day", "day_of_week", "month_num"]
CUBE_KEYS = [*CELL, *WINDOW]
DENSITY_FEATURES = [*CUBE_KEYS, "is_weekend", "is_night"]


def cube_keys(df: DataFrame, ts: str = "crime_timestamp", keep: Sequence[str] = ()) -> DataFrame:
    """Cell and window of every incident with a place and a time, and the columns to keep."""
    return df.filter(F.col("latitude").isNotNull() & F.col(ts).isNotNull()).select(
        *[c.alias(n) for n, c in geo_grid("latitude", "longitude").items()],
        F.hour(ts).alias("hour_of_day"),
        F.dayofweek(ts).alias("day_of_week"),
        F.month(ts).alias("month_num"),
        *keep,
    ).filter("lat_grid != 0.0")


def density_cube(
    df: DataFrame, ts: str = "crime_timestamp", at_least: int = 1
) -> DataFrame:
    """Incidents per cell, hour, weekday and month; rows without place or time drop out.

    ``at_least`` leaves out windows with fewer incidents. The weekend and night flags follow from hour and weekday, so they are added to
    the groups instead of widening the grouping key.
    """
    counts = cube_keys(df, ts).groupBy(*CUBE_KEYS).agg(F.count("*").alias("crime_count"))
    if at_least > 1:  # a group never has fewer than one row
        counts = counts.filter(F.col("crime_count") >= at_least)
    return (
        counts.withColumns({
            "is_weekend": weekend_flag("day_of_week"),
            "is_night": night_flag("hour_of_day"),
        })
        .select(*DENSITY_FEATURES, "crime_count")
    )


def heatmap(cube: DataFrame, measure: str = "crime_count") -> DataFrame:
    """Per cell: windows with incidents and the mean of a measure over them.

    The measure is the observed count, or ``prediction`` for a model's view.
    """
    return cube.groupBy(*CELL).agg(
        F.count("*").alias("time_windows"), F.avg(measure).alias("avg_crimes")
    )


def patrol_map(cells: DataFrame, box=CITY_BOX) -> DataFrame:
    """Cells in the box with signed longitude, label, city mean and heat weight."""
    inside = in_bbox(
        cells.withColumn("lon", -F.col("lon_grid_abs")), "lat_grid", "lon", box
    )
    scale = inside.agg(F.struct(
        F.max("avg_crimes").alias("top"), F.avg("avg_crimes").alias("mean"),
    )).scalar()
    return inside.withColumns({
        "cell": cell_label("lat_grid", "lon_grid_abs"),
        "weight": F.col("avg_crimes") / scale["top"],
        "city_avg": scale["mean"],
    })


def hotspots(cells: DataFrame, n: int = 20, box=CITY_BOX) -> DataFrame:
    """The n cells with the highest mean, ties by position."""
    return patrol_map(cells, box).orderBy(F.desc("avg_crimes"), *CELL).limit(n)
