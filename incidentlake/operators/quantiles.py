"""Exact quantiles of several columns at once, by counts in ranges that narrow.

Every pass is one scan for all columns and probabilities. It counts rows by bucket of an ordered key, finds the bucket that holds
each wanted rank, and the next pass splits only those buckets. The first pass buckets whole numbers by their
upper 16 bits and doubles by sign and sixteenth of a power of two; later ones cut what a bucket really spans into up to ``SPLITS``
equal parts. So 64 bits take at most four scans, and a value that is reached sooner, however many rows have it, ends its search.

No task holds more than a bucket count a range, and the driver one row per column and probability.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

SPLITS = 65_536
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NO_ZONE = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


@dataclass(frozen=True)
class _Target:
    """One wanted rank: the column by number, and the range of keys it is known to lie in."""

    column: int
    probability: float
    lo: float | int | None = None
    hi: float | int | None = None
    rank: int | None = None  # from 1, among the rows of the range
    done: bool = False


def _key(name: str, kind: T.DataType) -> Column:
    """A bigint or double in the order of the column."""
    c = F.col(f"`{name}`")
    if isinstance(kind, _WHOLE):
        return c.cast("bigint")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        micros = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
        minutes = F.unix_date(c.cast("date")).cast("bigint") * 1440 + F.hour(c) * 60 + F.minute(c)
        return minutes * 60_000_000 + micros
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (c * F.lit(10 ** kind.scale).cast("decimal(19,0)")).cast("bigint")
    raise ValueError(f"column {name!r} of type {kind.simpleString()} has no exact quantiles here")


def _value(name: str, kind: T.DataType) -> Column:
    """Back from the key to the column's type."""
    c = F.col(name)
    if isinstance(kind, T.DateType):
        c = F.date_from_unix_date(c.cast("int"))
    elif isinstance(kind, T.TimestampType):
        c = F.timestamp_micros(c)
    elif isinstance(kind, T.TimestampNTZType):
        c = F.expr(f"timestampadd(MICROSECOND, `{name}`, {_NO_ZONE})")
    elif isinstance(kind, T.DecimalType):
        c = c.cast("decimal(18,0)") / F.lit(10 ** kind.scale).cast("decimal(19,0)")
    return c.cast(kind)


def _first_bucket(key: Column, double: bool) -> Column:
    """A bucket that never falls as the key grows."""
    if not double:
        return F.shiftright(key, 48)
    size = F.floor(F.log2(F.abs(key)) * 16) + 40_000  # the smallest double gives -17,184
    signed = F.when(key == 0, 0).when(key < 0, -size).otherwise(size)
    return F.when(F.isnan(key), 200_000).when(key == float("inf"), 100_000).when(key == float("-inf"), -100_000).otherwise(signed)


def _next_bucket(key: Column, double: bool, lo, hi) -> Column:
    if double:
        return F.floor((key - F.lit(lo)) / F.lit(hi - lo) * SPLITS)
    # a first bucket spans less than 48 bits, so whole steps of a power of two stay exact
    return F.shiftright(key - F.lit(lo), max(0, (hi - lo).bit_length() - 16))


def _ranges(targets: Sequence[_Target]) -> list[tuple]:
    """Distinct open ranges as (column, lo, hi); their place is their number."""
    return list(dict.fromkeys((t.column, t.lo, t.hi) for t in targets))


def _count(keys: DataFrame, doubles: list[bool], ranges: list[tuple]) -> DataFrame:
    """Rows, smallest and largest key by range and bucket, in one scan."""
    entries, reached = [], []
    for column, double in enumerate(doubles):
        key, entry = F.col(f"k{column}"), F.lit(None)
        for number, (of, lo, hi) in enumerate(ranges):
            if of != column:
                continue
            inside = key.isNotNull() if lo is None else key.between(lo, hi)
            bucket = _first_bucket(key, double) if lo is None else _next_bucket(key, double, lo, hi)
            here = F.struct(
                F.lit(number).alias("range"), bucket.cast("bigint").alias("bucket"),
                (F.lit(None) if double else key).cast("bigint").alias("whole"),
                (key if double else F.lit(None)).cast("double").alias("real"))
            entry = F.when(inside, here).otherwise(entry)
            reached.append(inside)
        if any(of == column for of, _, _ in ranges):
            entries.append(entry)
    rows = keys.filter(reduce(Column.__or__, reached)).select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    return rows.groupBy("range", "bucket").agg(
        F.count("*").alias("rows"), *[f(c).alias(f"{n}_{c}") for c in ("whole", "real") for n, f in (("lo", F.min), ("hi", F.max))])


def _narrow(counts: DataFrame, targets: list[_Target], ranges: list[tuple]) -> list[_Target]:
    """Every target in the bucket that holds its rank."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame(
        [(i, ranges.index((t.column, t.lo, t.hi)), t.probability, t.rank) for i, t in enumerate(targets)],
        "target int, range int, probability double, rank bigint")
    in_range = Window.partitionBy("range")  # a range has a bounded number of buckets
    summed = counts.withColumn("upto", F.sum("rows").over(in_range.orderBy("bucket"))) \
        .withColumn("total", F.sum("rows").over(in_range))
    first = F.greatest(F.lit(1), F.col("total") - F.floor(F.col("total") - F.col("probability") * F.col("total")))
    at = summed.join(F.broadcast(wanted), "range").withColumn("rank", F.coalesce("rank", first.cast("bigint")))
    at = at.filter((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("rows")))
    one = F.coalesce(F.col("lo_whole") == F.col("hi_whole"), F.col("lo_real") == F.col("hi_real"))
    found = []
    for r in at.withColumn("rank", F.col("rank") - F.col("upto") + F.col("rows")).withColumn("one", one).collect():
        lo, hi = (r.lo_whole, r.hi_whole) if r.lo_whole is not None else (r.lo_real, r.hi_real)
        found.append(replace(targets[r.target], lo=lo, hi=hi, rank=r["rank"], done=r.one))
    return found


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """One row per probability with the value of every column at it, in the column's own type.

    The value at p of n values is the one at place n - floor(n - p * n), at least 1, in ascending order: always a value that
    occurs, as a discrete quantile in SQL. NULL is no value; NaN is above all others. A column without values gives NULL. Whole
    numbers, doubles, dates, timestamps and decimals of up to 18 digits have quantiles; other types are refused.
    """
    bad = [p for p in probabilities if not 0 <= p <= 1]
    if bad:
        raise ValueError(f"probabilities lie between 0 and 1, not {bad}")
    spark = df.sparkSession
    kinds = [df.schema[c].dataType for c in columns]
    doubles = [isinstance(k, (T.FloatType, T.DoubleType)) for k in kinds]
    keys = df.select(*[_key(c, k).alias(f"k{i}") for i, (c, k) in enumerate(zip(columns, kinds, strict=True))])
    ended: list[_Target] = []
    targets = [_Target(c, p) for c in range(len(columns)) for p in dict.fromkeys(map(float, probabilities))]
    while targets:
        ranges = _ranges(targets)
        found = _narrow(_count(keys, doubles, ranges), targets, ranges)
        ended += [t for t in found if t.done]
        targets = [t for t in found if not t.done]
    at = {(t.probability, t.column): t.lo for t in ended}
    rows = [(float(p), *[at.get((float(p), c)) for c in range(len(columns))]) for p in probabilities]
    schema = ", ".join(["probability double", *[f"k{i} {'double' if d else 'bigint'}" for i, d in enumerate(doubles)]])
    return spark.createDataFrame(rows, schema).select(
        "probability", *[_value(f"k{i}", k).alias(c) for i, (c, k) in enumerate(zip(columns, kinds, strict=True))])
