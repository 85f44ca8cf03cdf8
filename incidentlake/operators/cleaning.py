"""Deduplication, null handling and cleaning audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import is_missing
from ..schema import CITY_BOX


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every column; NaN counts as missing.

    Plain null tests, unlike ``dropna``, reach the Parquet reader.
    """
    kinds = dict(df.dtypes)
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
        if kinds[c] in ("double", "float"):
            df = df.filter(~F.isnan(c))
    return df


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order_by``, which should be a total order.

    Spark keeps only the best row per key on the map side before it shuffles
    (a partial window group limit), so one key holding a large part of the rows
    sends at most one row per input task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def clean_audit(df: DataFrame, required: Sequence[str], key: str) -> DataFrame:
    """Row counts before cleaning, after the null drop and after deduplication.

    One pass and one row: the distinct count equals what ``dedupe`` keeps.
    """
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    kept = F.count_distinct(F.when(complete, F.col(key)))
    return df.agg(
        F.count("*").alias("rows_before"),
        F.count_if(complete).alias("rows_complete"),
        kept.alias("rows_unique"),
    )


def missing_profile(
    df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = ()
) -> DataFrame:
    """Missing values per column, worst first, from a single aggregation."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(is_missing(c, c in numeric)).alias(c) for c in columns],
    )
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in columns
    ]))
    pct = F.when(
        F.col("_rows") > 0, F.round(F.col("null_count") / F.col("_rows") * 100, 2)
    ).otherwise(0.0)
    return (
        counts.select("_rows", pairs.alias("p")).select("_rows", "p.*")
        .select("column", "null_count", pct.alias("null_pct"))
        .orderBy(F.desc("null_pct"), "column")
    )


def in_bbox(df: DataFrame, lat: str, lon: str, box=CITY_BOX) -> DataFrame:
    """Rows inside the box, ends included; rows without coordinates drop out."""
    lat_lo, lat_hi, lon_lo, lon_hi = box
    return df.filter(F.col(lat).between(lat_lo, lat_hi) & F.col(lon).between(lon_lo, lon_hi))


def fill_missing_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero for NULL and NaN in the given numeric columns."""
    return df.fillna(0.0, subset=list(columns))
