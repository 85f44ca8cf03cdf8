"""Silver and gold laid out for reading little: a folder for each event day, rows by district within its files.

A filter on the event day picks folders while the query is planned; a join with a few chosen days picks them while it runs, once those
days are known. Within a file the rows of a district lie together, so the reader skips row groups by the statistics of the Parquet footer.

Rows are rebalanced by day before they are written: adaptive execution joins small days in a task and splits a day that holds a
large part of all rows over several tasks and files, so no task holds a hot day whole and a day has no more files than its size asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The folder column; rows without a time lie in the folder of NULL.
DAY = "event_day"


def by_day(df: DataFrame, ts: str = "crime_timestamp", within: tuple[str, ...] = ("district",)) -> DataFrame:
    """Rows with their event day, rebalanced by it and sorted as files want them."""
    dated = df.withColumn(DAY, F.to_date(ts))
    return dated.hint("rebalance", F.col(DAY)).sortWithinPartitions(DAY, *within)


def write_by_day(
    df: DataFrame, path: str, ts: str = "crime_timestamp", within: tuple[str, ...] = ("district",),
    days_only: bool = False, row_group: int = 16 << 20,
) -> None:
    """Write a layer by event day. ``days_only`` replaces the days that ``df`` has and leaves the other folders as they are.

    ``row_group`` is the size in bytes at which the reader can skip.
    """
    writer = by_day(df, ts, within).write.mode("overwrite").partitionBy(DAY).option("parquet.block.size", str(row_group))
    writer.option("partitionOverwriteMode", "dynamic" if days_only else "static").parquet(path)


def read_days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of the days from ``first`` to ``last``, both included; other folders are not listed in the scan."""
    rows = spark.read.parquet(path)
    wanted: Column = F.lit(True)
    if first is not None:
        wanted = wanted & (F.col(DAY) >= F.lit(first).cast("date"))
    if last is not None:
        wanted = wanted & (F.col(DAY) <= F.lit(last).cast("date"))
    return rows if first is None and last is None else rows.filter(wanted)


def on_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the days in ``days`` (column ``event_day``); the scan reads the folders of those days alone.

    ``days`` has at most one row for each folder, which bounds its broadcast.
    """
    wanted = days.select(DAY).filter(f"{DAY} IS NOT NULL").distinct()
    return rows.join(F.broadcast(wanted), DAY, "left_semi")
