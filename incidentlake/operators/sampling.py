"""Splits, samples and pages that do not depend on how the data is laid out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_PARTS = 10_000


def _key_digest(keys: Sequence[str], seed: int) -> Column:
    """MD5 of the key values as text, which other engines compute alike."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def hash_part(keys: Sequence[str], seed: int, parts: int = _PARTS) -> Column:
    """A bucket in ``[0, parts)`` that depends on the key values and the seed only."""
    number = F.conv(F.substring(_key_digest(keys, seed), 1, 12), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(parts))


def split(
    df: DataFrame, keys: Sequence[str], train: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete train and test parts; equal keys stay on one side."""
    part = hash_part(keys, seed)
    cut = round(train * _PARTS)
    return df.filter(part < cut), df.filter(part >= cut)


def cap_rows(df: DataFrame, keys: Sequence[str], target: int, rows: int, seed: int = 42) -> DataFrame:
    """About ``target`` of ``rows`` rows, chosen by key hash; all rows when they fit.

    For capping training data only; evaluation data is never passed through here.
    """
    if rows <= target:
        return df
    resolution = 2**31
    # a second seed keeps the choice independent of ``split``
    return df.filter(hash_part(keys, seed + 1, resolution) < int(resolution * target / rows))


def sample_fraction(df: DataFrame, keys: Sequence[str], n: int, rows: int, seed: int = 42) -> DataFrame:
    """About n of ``rows`` rows for a chart, chosen by key hash as ``cap_rows`` does."""
    return cap_rows(df, keys, n, rows, seed)


def sample_exact(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: those with the smallest key digests.

    A count per hash bucket finds the bucket where the n-th row lies, so only
    about n rows, not all of them, enter the ranking.
    """
    buckets = 2**16
    bucket = hash_part([key], seed, buckets)
    per_bucket = df.select(bucket.alias("b")).groupBy("b").agg(F.count("*").alias("c"))
    # at most ``buckets`` rows pass through this window
    running = F.sum("c").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    cut = per_bucket.withColumn("before", F.coalesce(running, F.lit(0))) \
        .filter(F.col("before") < n).agg(F.max("b")).scalar()
    return (
        df.filter(bucket <= cut).withColumn("_b", bucket)
        .withColumn("_h", _key_digest([key], seed)).orderBy("_b", "_h", key).limit(n).drop("_b", "_h")
    )


# --- pages ----------------------------------------------------------------------------

# Ranges that a page index counts rows in.
_RANGES = 2048
# Rows that a task may keep for a page; a page that ends further down needs a page index.
TOP_ROWS = 100_000


def _newest_first(order_by: str, tie: str) -> list[Column]:
    return [F.desc_nulls_last(order_by), F.asc_nulls_first(tie)]


def newest_records(
    df: DataFrame, order_by: str, tie: str, limit: int, offset: int = 0,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows ``offset .. offset+limit`` of the frame ordered newest first, ties by ``tie``.

    A page near the top is a bounded top-k in every task. One further down takes a page index, which
    is worth keeping if there are more such pages; pages in a row take ``next_page``.
    """
    columns = list(columns or df.columns)
    if offset + limit <= TOP_ROWS:
        return df.orderBy(*_newest_first(order_by, tie)).offset(offset).limit(limit).select(*columns)
    return PageIndex.build(df, order_by, tie).page(df, limit, offset, columns)


def next_page(
    df: DataFrame, order_by: str, tie: str, limit: int, cursor: tuple | None = None,
    columns: Sequence[str] | None = None,
) -> tuple[DataFrame, tuple | None]:
    """The rows behind a cursor, newest first, and the cursor of their last row; no cursor follows the last page.

    A cursor is (order value, tie) of a row. It becomes a range on the order column that reaches the reader, so no page
    sorts or skips what was before it. Rows whose order and tie are equal are not told apart: ``tie`` should be unique.
    """
    columns = list(columns or df.columns)
    rows = df.select(*dict.fromkeys([*columns, order_by, tie]))
    if cursor is not None:
        value, last = (F.lit(v) for v in cursor)
        order, t = F.col(order_by), F.col(tie)
        behind = t > last if cursor[1] is not None else t.isNotNull()
        if cursor[0] is None:  # among the rows without a value, which come last
            rows = rows.filter(order.isNull() & behind)
        else:
            rows = rows.filter(order.isNull() | (order <= value)).filter(order.isNull() | (order < value) | behind)
    page = rows.orderBy(*_newest_first(order_by, tie)).limit(limit)
    found = page.collect()  # one page
    after = (found[-1][order_by], found[-1][tie]) if len(found) == limit and limit else None
    return df.sparkSession.createDataFrame(found, rows.schema).select(*columns), after


class PageIndex:
    """How many rows lie in ranges of the order column: pages at any offset read and sort only the ranges they need.

    Ranges are cut at approximate quantiles, so they hold about equally many rows whatever the values look like;
    a value that fills several ranges is one range. Built by two scans, used for any number of pages.
    """

    def __init__(self, order_by: str, tie: str, counts: list[tuple]):
        # newest first: (lowest value, rows); the last range has no lowest value and holds the rows without a value
        self.order_by, self.tie, self.counts = order_by, tie, counts
        self.rows = sum(n for _, n in counts)

    @classmethod
    def build(cls, df: DataFrame, order_by: str, tie: str, ranges: int = _RANGES) -> PageIndex:
        return cls(order_by, tie, cls._counted(df, order_by, cls._edges(df, order_by, tie, ranges)))

    @staticmethod
    def _edges(df: DataFrame, name: str, tie: str, ranges: int) -> list:
        """Distinct values at about equal distances in the sorted column, from a sample of fixed size: the rows with the smallest hashes."""
        chosen = df.filter(F.col(name).isNotNull()).select(F.col(name).alias("v"), F.xxhash64(name, tie).alias("h")).orderBy("h").limit(16 * ranges)
        values = sorted(r.v for r in chosen.collect())
        return sorted(set(values[::max(1, len(values) // ranges)]))

    @staticmethod
    def _counted(df: DataFrame, name: str, edges: list) -> list[tuple]:
        """(lowest value or None, rows) of each range, newest first; the range below all edges has the value None."""
        if not edges:
            rows = df.agg(F.count("*")).first()[0]
            return [(None, rows)]
        bounds = F.array(*[F.lit(e) for e in edges])
        kind = df.schema[name].dataType.simpleString()
        place = F.when(F.col(name).isNull(), F.lit(-2)).otherwise(_rank(F.col(name), bounds.cast(f"array<{kind}>"), len(edges)))
        found = dict(df.groupBy(place.alias("p")).count().collect())
        out = [(edges[k], found.get(k, 0)) for k in range(len(edges) - 1, -1, -1)]
        return [*out, (None, found.get(-1, 0) + found.get(-2, 0))]

    def page(self, df: DataFrame, limit: int, offset: int = 0, columns: Sequence[str] | None = None) -> DataFrame:
        """Rows ``offset .. offset+limit``, newest first."""
        columns = list(columns or df.columns)
        rows = df.select(*dict.fromkeys([*columns, self.order_by, self.tie]))
        seen, skipped, first, last = 0, 0, None, None
        for k, (_, n) in enumerate(self.counts):
            if first is None and seen + n > offset:
                first, skipped = k, seen
            seen += n
            if first is not None:
                last = k
                if seen >= offset + limit:
                    break
        if first is None:  # behind the last row
            return rows.filter("false").select(*columns)
        order = F.col(self.order_by)
        low, above = self.counts[last][0], self.counts[first - 1][0] if first else None
        if low is not None:
            rows = rows.filter(order >= F.lit(low))
        if above is not None:
            rows = rows.filter(order < F.lit(above) if low is not None else order.isNull() | (order < F.lit(above)))
        return rows.orderBy(*_newest_first(self.order_by, self.tie)).offset(offset - skipped).limit(limit).select(*columns)


def _rank(value: Column, bounds: Column, size: int) -> Column:
    """How many of the sorted bounds a value reaches, less one, by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(size.bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(-1), lambda place, step: F.when(
        (place + step < size) & (F.get(bounds, place + step) <= value), place + step).otherwise(place))
