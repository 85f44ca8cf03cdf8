"""Frequencies, rates, profiles, histograms and rankings."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.casts import _col
from ..schema import WEEKDAYS
from .cleaning import drop_missing


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def frequency(df: DataFrame, key, drop_null_keys: bool = False) -> DataFrame:
    """Rows per key; a NULL key is a group of its own unless dropped."""
    keys = _keys(key)
    if drop_null_keys:
        df = drop_missing(df, keys)
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def top_k(df: DataFrame, key, k: int, drop_null_keys: bool = False) -> DataFrame:
    """The k most frequent keys, most frequent first, ties by key."""
    keys = _keys(key)
    return frequency(df, keys, drop_null_keys).orderBy(F.desc("count"), *keys).limit(k)


def filter_top_k(df: DataFrame, key: str, k: int, among: DataFrame | None = None) -> DataFrame:
    """Rows whose key is one of the k most frequent (of ``among``, default the frame)."""
    leaders = top_k(df if among is None else among, key, k, drop_null_keys=True)
    # at most k rows by construction
    return df.join(F.broadcast(leaders.select(key)), key, "left_semi")


def distinct_values(df: DataFrame, columns: Sequence[str], include_null: bool = True) -> DataFrame:
    """Distinct values per column in one pass; NULL counts as a value if asked."""
    counted = []
    for c in columns:
        n = F.count_distinct(c)
        if include_null:
            n = n + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))
        counted.append(n.cast("bigint").alias(c))
    return to_long(df.agg(*counted), columns, "column", "distinct_values")


def to_long(wide: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns of a small frame as ``(name, value)`` rows."""
    kept = [c for c in wide.columns if c not in columns]
    return wide.unpivot([F.col(c) for c in kept], list(columns), name, value)


def value_range(df: DataFrame, c) -> DataFrame:
    return df.agg(F.min(_col(c)).alias("min_value"), F.max(_col(c)).alias("max_value"))


def share(df: DataFrame, predicate: Column) -> DataFrame:
    """Matching rows and their percentage; an empty frame has share 0."""
    hits, rows = F.count_if(predicate), F.count("*")
    return df.agg(
        rows.alias("rows"),
        hits.alias("matching"),
        F.when(rows > 0, 100.0 * hits / rows).otherwise(0.0).alias("pct"),
    )


def rate_by(
    df: DataFrame, key: str, flag: Column, k: int | None = None,
    digits: int | None = None, mark_above: bool = False,
) -> DataFrame:
    """Percentage of flagged rows per key (of the k most frequent keys).

    With ``mark_above`` each rate is compared with the plain mean of the listed
    rates. All of it comes from one aggregation: the k leaders are picked from the
    grouped counts, so the input is scanned once.
    """
    grouped = drop_missing(df, [key]).groupBy(key).agg(
        F.count("*").alias("count"),
        (F.avg(flag.cast("double")) * 100).alias("rate_pct"),
    )
    if k is not None:
        grouped = grouped.orderBy(F.desc("count"), key).limit(k)
    if digits is not None:
        grouped = grouped.withColumn("rate_pct", F.round("rate_pct", digits))
    if mark_above:
        if k is None:
            mean = grouped.agg(F.avg("rate_pct")).scalar()
        else:  # k rows, so one partition is enough
            mean = F.avg("rate_pct").over(Window.partitionBy())
        grouped = grouped.withColumn("mean_pct", mean)
        grouped = grouped.withColumn("above_mean", F.col("rate_pct") > F.col("mean_pct"))
    return grouped


# Summary statistics by name. Quantiles are mergeable sketches, so no task ever
# holds a whole column.
QUANTILE_ACCURACY = 10000
DESCRIBE_STATS = ("count", "mean", "stddev", "min", "max")
SUMMARY_STATS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def _stat(name: str, c: str) -> Column:
    x = F.col(c)
    if name.endswith("%"):
        q = float(name[:-1]) / 100
        return F.percentile_approx(x, F.lit(q), F.lit(QUANTILE_ACCURACY))
    return {
        "count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max,
    }[name](x)


def profile(
    df: DataFrame, columns: Sequence[str], stats: Sequence[str] = DESCRIBE_STATS
) -> DataFrame:
    """One row per numeric column with the chosen statistics, from one aggregation."""
    one_row = df.agg(*[
        F.struct(*[_stat(s, c).cast("double").alias(s) for s in stats]).alias(c)
        for c in columns
    ])
    return to_long(one_row, columns, "column", "stats").select("column", "stats.*")


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form over all rows, each pair on its complete rows."""
    def clean(c):
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x)

    pairs = list(combinations(columns, 2)) + [(c, c) for c in columns]
    one_row = df.agg(*[
        F.corr(clean(a), clean(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)
    ])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(
                F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"r{i}").alias("r")))
    return one_row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def histogram(
    df: DataFrame, c, bins: int, by: Sequence[str] = (), value_range: tuple | None = None
) -> DataFrame:
    """Equal-width histogram with empty bins shown; the top edge is in the last bin.

    The range comes from a one-row subquery unless it is given; a value outside a given
    range is an error, so the counts always add up to the known values.
    """
    x = _col(c).cast("double")
    values = df.select(*by, x.alias("_x")).filter("_x is not null and not isnan(_x)")
    if value_range is None:
        span = values.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
        lo, hi = span["lo"], span["hi"]
    else:
        lo, hi = F.lit(float(value_range[0])), F.lit(float(value_range[1]))
        outside = F.raise_error(F.lit(f"a value is outside the range {value_range}"))
        values = values.withColumn("_x", F.when(F.col("_x").between(lo, hi), F.col("_x")).otherwise(outside))
    # a single-valued column gets a range of width one around the value
    flat = lo == hi
    first = F.when(flat, lo - 0.5).otherwise(lo)
    width = F.when(flat, F.lit(1.0)).otherwise(hi - lo) / bins
    bin_no = F.least(F.floor((F.col("_x") - first) / width), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(*by, bin_no.alias("bin")).agg(F.count("*").alias("n"))
    # at most bins rows per group of ``by``
    full = (
        counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
        .select(*by, "m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    )
    return full.select(
        *by, "bin",
        (first + F.col("bin") * width).alias("lower"),
        (first + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).alias("count"),
    )


def busiest_quietest(df: DataFrame, ts: str) -> DataFrame:
    """Busiest and quietest calendar day and the mean per day; ties to the earlier day."""
    daily = frequency(df.select(F.to_date(ts).alias("day")), "day", drop_null_keys=True)
    since = F.unix_date("day")
    return daily.agg(
        F.max_by("day", F.struct("count", -since)).alias("busiest_day"),
        F.max("count").alias("busiest_count"),
        F.min_by("day", F.struct("count", since)).alias("quietest_day"),
        F.min("count").alias("quietest_count"),
        F.avg("count").alias("mean_per_day"),
    )


def weekday_table(spark) -> DataFrame:
    """The seven day names with their display position."""
    rows = ", ".join(f"({i}, '{n}', {number})" for i, (number, n) in enumerate(WEEKDAYS, 1))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(position, day, day_of_week)")


def order_by_day(df: DataFrame, day: str = "day", measure: str = "count") -> DataFrame:
    """Monday to Sunday, a missing day shown with 0."""
    days = weekday_table(df.sparkSession).select("position", F.col("day").alias("_day"))
    return (
        days.join(df, F.col("_day") == F.col(day), "left")
        .select(
            "position", F.col("_day").alias("day"),
            F.coalesce(measure, F.lit(0)).alias(measure),
        )
        .orderBy("position")
    )


def weekday_hour_matrix(df: DataFrame, ts: str) -> DataFrame:
    """Weekday by hour counts, days Monday first, one column per hour, in one aggregation."""
    dated = df.filter(F.col(ts).isNotNull()).select(
        F.dayofweek(ts).alias("day_of_week"), F.hour(ts).alias("hour")
    )
    wide = dated.groupBy("day_of_week").agg(
        *[F.count_if(F.col("hour") == h).alias(f"h{h:02d}") for h in range(24)])
    # seven rows at most
    return (
        weekday_table(df.sparkSession).join(F.broadcast(wide), "day_of_week", "left")
        .drop("day_of_week").fillna(0).orderBy("position")
    )


def best_row(df: DataFrame, measure: str, tie: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(measure), tie).limit(1)
