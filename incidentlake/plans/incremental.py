"""Silver, marts and density cube kept up to date by increments instead of rebuilds.

A bucketed table holds one row per key: the first in the order, whenever its copies arrive. Rows lie in folders by
a hash of their key, and an increment rewrites only the buckets where a new row wins. No lake format is needed:

1. *Stage*: the changes (new winners with sign 1, the rows they replace with sign -1) and the new contents of the changed
   buckets are written beside the table.
2. *Publish*: dynamic partition overwrite puts the staged buckets in place.
3. *Fold*: signed counts of the changes become partial aggregates under the number of the increment.
4. The staged data goes.

Until step 1 is complete nothing has happened; from then on the rest can be repeated any number of times with the same
result, so ``increment`` first ends what a lost driver left behind. An increment whose number is done is skipped, so a
stream may deliver it again.

Marts and cube are sums of signed counts, so partial aggregates of any batches can be merged in any order. ``compact`` sums
the partials up to a number into one base; a reader takes the newest complete base and the partials after it, so
every increment counts once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.cleaning import dedupe
from ..operators.density import CELL, CUBE_KEYS, cube_keys
from ..sources.writers import list_folder, path_exists, remove_path
from .layers import SILVER_KEY, SILVER_ORDER, complete, typed

#: Folders of a bucketed table; a table keeps the number it was made with.
BUCKETS = 64
SIGN = "_sign"
#: What the partial counts read of a row.
COUNTED = ("primary_type", "crime_timestamp", "district", "latitude", "longitude")
#: Of the files of a table: silver rows hold their JSON text beside its fields, which zstd halves.
CODEC = "zstd"
#: Bytes of row groups that the open files of a task buffer together.
BUFFERED = 64 << 20
#: Of each open file: a column that repeats little gives its dictionary up after the first page, so pages are short.
PAGES = {"parquet.page.row.count.limit": "2000", "parquet.dictionary.page.size": str(256 << 10)}
DONE = "_SUCCESS"


@dataclass(frozen=True)
class Bucketed:
    """Where a table with one row per key lies, and what its first row is."""

    root: str
    key: str = SILVER_KEY
    order: tuple[str, ...] = SILVER_ORDER
    buckets: int = BUCKETS

    @property
    def rows(self) -> str:
        return f"{self.root}/rows"

    @property
    def staged(self) -> str:
        return f"{self.root}/staged"

    @property
    def partials(self) -> str:
        return f"{self.root}/partials"

    @property
    def bases(self) -> str:
        return f"{self.root}/bases"

    def bucket(self) -> Column:
        """The folder of a row; it names the number of folders, so that another number is noticed."""
        number = F.pmod(F.xxhash64(self.key), F.lit(self.buckets))
        return F.format_string(f"%05d-of-{self.buckets}", number)


def read_rows(spark: SparkSession, table: Bucketed) -> DataFrame | None:
    """The rows of the table with their bucket; nothing if there are none yet."""
    if not path_exists(spark, table.rows):
        return None
    rows = spark.read.parquet(table.rows)
    return rows.withColumn("bucket", F.col("bucket").cast("string"))


def _done(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{DONE}")


@contextmanager
def _unsorted_writes(spark: SparkSession, buckets: int) -> Iterator[None]:
    """Writers of all buckets of a task stay open, so rows go to their folders without a shuffle or a sort."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(buckets + 1))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _write_buckets(spark: SparkSession, table: Bucketed, rows: DataFrame, path: str, **options: str) -> None:
    """Rows to the folders of their buckets. Tasks read whole splits of files, so a bucket gets at most a file a split."""
    bounds = {"parquet.block.size": str(max(BUFFERED // table.buckets, 1 << 20)), **PAGES}
    with _unsorted_writes(spark, table.buckets):
        rows.write.mode("overwrite").options(compression=CODEC, **bounds, **options).partitionBy("bucket").parquet(path)


def _changes(spark: SparkSession, table: Bucketed, new: DataFrame) -> DataFrame:
    """Signed rows that an increment adds and takes away. Of a row that goes, key, bucket and what the counts read are told.

    Of the stored rows only these and the order are compared, of buckets that the increment reaches. One join finds winners and the
    rows they replace, on the partitions that ``dedupe`` has made.
    """
    new = new.withColumns({"bucket": table.bucket(), "_k": F.struct(table.key)})  # a struct: NULL keys are equal
    firsts = dedupe(new, ["_k"], table.order)
    stored = read_rows(spark, table)
    if stored is None:
        return firsts.drop("_k").withColumn(SIGN, F.lit(1))
    other = stored.select("bucket").distinct().filter(~F.col("bucket").endswith(f"-of-{table.buckets}")).limit(1).collect()
    if other:
        raise ValueError(f"the table has buckets like {other[0].bucket!r}, not {table.buckets} of them")
    reached = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` names
    old = stored.filter(F.col("bucket").isin(reached))
    known = old.select(F.struct(table.key).alias("_k"), F.struct(*table.order).alias("_first"), F.struct(*COUNTED).alias("_was"))
    ahead = F.col("_first").isNull() | (F.struct(*table.order) < F.col("_first"))
    winners = firsts.join(known, "_k", "left").filter(ahead)
    signs = F.when(F.col("_first").isNull(), F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(-1)))
    signed = winners.withColumn(SIGN, F.explode(signs))
    is_new = F.col(SIGN) == 1

    def told(name):
        if name in (table.key, "bucket"):
            return F.col(name)
        return F.when(is_new, F.col(name)).otherwise(F.col("_was")[name] if name in COUNTED else F.lit(None)).alias(name)
    return signed.select(*[told(c) for c in firsts.columns if c != "_k"], SIGN)


def _stage(spark: SparkSession, table: Bucketed, new: DataFrame, number: int) -> None:
    target = f"{table.staged}/{number}"
    _changes(spark, table, new).write.mode("overwrite").option("compression", CODEC).parquet(f"{target}/changes")
    changes = spark.read.parquet(f"{target}/changes")
    added = changes.filter(f"{SIGN} = 1").drop(SIGN)
    stored = read_rows(spark, table)
    changed = [] if stored is None else sorted(r.bucket for r in added.select("bucket").distinct().collect())
    if changed:
        gone = changes.filter(f"{SIGN} = -1").select(F.col(table.key).alias("_key"))
        old = stored.filter(F.col("bucket").isin(changed))
        kept = old.join(gone, old[table.key].eqNullSafe(gone["_key"]), "left_anti")
        added = kept.unionByName(added)
    _write_buckets(spark, table, added, f"{target}/buckets")


def _publish(spark: SparkSession, table: Bucketed, number: int) -> None:
    source = f"{table.staged}/{number}/buckets"
    if not any(n.startswith("bucket=") for n in list_folder(spark, source)):  # no bucket has changed
        return
    rows = spark.read.parquet(source).withColumn("bucket", F.col("bucket").cast("string"))
    _write_buckets(spark, table, rows, table.rows, partitionOverwriteMode="dynamic")


def _fold(spark: SparkSession, table: Bucketed, number: int) -> None:
    changes = spark.read.parquet(f"{table.staged}/{number}/changes")
    for name, counts in (("marts", mart_counts(changes)), ("cube", cube_counts(changes))):
        counts.write.mode("overwrite").parquet(f"{table.partials}/{name}/{number}")


def _is_done(spark: SparkSession, table: Bucketed, number: int) -> bool:
    base = _newest_base(spark, table)
    return base is not None and number <= base or _done(spark, f"{table.partials}/cube/{number}")


def _pending(spark: SparkSession, table: Bucketed) -> list[int]:
    """Increments whose stage is complete."""
    found = [int(n) for n in list_folder(spark, table.staged) if n.isdigit()]
    return sorted(n for n in found if _done(spark, f"{table.staged}/{n}/buckets"))


def finish(spark: SparkSession, table: Bucketed) -> list[int]:
    """End increments that were staged but not put in place; returns their numbers."""
    pending = _pending(spark, table)
    for number in pending:
        if not _is_done(spark, table, number):
            _publish(spark, table, number)
            _fold(spark, table, number)
        remove_path(spark, f"{table.staged}/{number}")
    return pending


def increment(spark: SparkSession, table: Bucketed, new: DataFrame, number: int) -> bool:
    """Take new silver rows into the table and its partial aggregates; False if this number was done before.

    Numbers grow, and one increment runs at a time.
    """
    finish(spark, table)
    if _is_done(spark, table, number):
        return False
    _stage(spark, table, new, number)
    finish(spark, table)
    return True


def silver_rows(bronze: DataFrame) -> DataFrame:
    """Typed, complete rows of bronze, copies included; an increment chooses among them."""
    return typed(complete(bronze))


# --- partial aggregates -------------------------------------------------------------

#: Key column and expression of the marts by name; a mart's other keys are NULL in a partial.
MARTS = {
    "by_type": ("primary_type", "primary_type"),
    "hourly": ("hour", "hour(crime_timestamp)"),
    "by_district": ("district", "district"),
    "daily": ("day", "to_date(crime_timestamp)"),
}
#: Marts that leave rows without a time out, as the time-bucket counts do.
_DATED = ("hourly", "daily")


def mart_counts(rows: DataFrame) -> DataFrame:
    """Signed counts of all marts by one grouping-sets aggregation: mart, its key column, count."""
    keyed = rows.select(*[F.expr(expression).alias(key) for key, expression in MARTS.values()], F.col(SIGN).alias("n"))
    keys = [key for key, _ in MARTS.values()]
    sets = [[F.col(key)] for key in keys]
    grouped = keyed.groupingSets(sets, *[F.col(k) for k in keys]).agg(F.sum("n").alias("count"), F.grouping_id(*keys).alias("_set"))
    # bit k of the id, from the left, is 0 for the key that is grouped by
    whole = 2 ** len(keys) - 1
    name = F.lit(None).cast("string")
    for k, mart in enumerate(MARTS):
        name = F.when(F.col("_set") == whole - 2 ** (len(keys) - 1 - k), mart).otherwise(name)
    counts = grouped.select(name.alias("mart"), *keys, "count").filter("count <> 0")
    undated = F.lit(False)
    for mart in _DATED:
        undated = undated | ((F.col("mart") == mart) & F.col(MARTS[mart][0]).isNull())
    return counts.filter(~undated)


def cube_counts(rows: DataFrame) -> DataFrame:
    """Signed counts of the density cube's cells and windows."""
    return cube_keys(rows, "crime_timestamp", keep=[SIGN]).groupBy(*CUBE_KEYS).agg(F.sum(SIGN).alias("crime_count")).filter("crime_count <> 0")


def merge_counts(parts: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Partial signed counts as one; keys whose rows are all gone drop out."""
    return parts.groupBy(*keys).agg(F.sum(count).alias(count)).filter(F.col(count) != 0)


_KEYS = {"marts": (["mart", *[key for key, _ in MARTS.values()]], "count"), "cube": (list(CUBE_KEYS), "crime_count")}


def _newest_base(spark: SparkSession, table: Bucketed) -> int | None:
    """The number up to which a complete base has everything."""
    found = [int(n) for n in list_folder(spark, table.bases) if n.isdigit()]
    return max((n for n in found if _done(spark, f"{table.bases}/{n}/cube")), default=None)


def _open_partials(spark: SparkSession, table: Bucketed, name: str, base: int | None) -> list[int]:
    found = [int(n) for n in list_folder(spark, f"{table.partials}/{name}") if n.isdigit()]
    return sorted(n for n in found if (base is None or n > base) and _done(spark, f"{table.partials}/{name}/{n}"))


def read_counts(spark: SparkSession, table: Bucketed, name: str) -> DataFrame:
    """Merged counts of ``marts`` or ``cube``: the newest base and the partials after it."""
    base = _newest_base(spark, table)
    paths = [] if base is None else [f"{table.bases}/{base}/{name}"]
    paths += [f"{table.partials}/{name}/{n}" for n in _open_partials(spark, table, name, base)]
    if not paths:
        raise ValueError(f"{table.root!r} has no increments")
    keys, count = _KEYS[name]
    return merge_counts(spark.read.parquet(*paths), keys, count)


def read_mart(spark: SparkSession, table: Bucketed, mart: str) -> DataFrame:
    """One of the four marts, as ``gold_marts`` builds it."""
    return read_counts(spark, table, "marts").filter(F.col("mart") == mart).select(MARTS[mart][0], "count")


def read_heatmap(spark: SparkSession, table: Bucketed) -> DataFrame:
    """Windows and mean count per cell, from the merged cube."""
    return read_counts(spark, table, "cube").groupBy(*CELL).agg(
        F.count("*").alias("time_windows"), F.avg("crime_count").alias("avg_crimes"))


def compact(spark: SparkSession, table: Bucketed) -> int | None:
    """Sum all partials into a new base; returns its number. What it replaces goes once it is complete."""
    finish(spark, table)
    before = _newest_base(spark, table)
    numbers = _open_partials(spark, table, "cube", before)
    if numbers:
        for name in ("marts", "cube"):  # the cube comes last: its mark makes the base count
            read_counts(spark, table, name).write.mode("overwrite").parquet(f"{table.bases}/{numbers[-1]}/{name}")
    base = _newest_base(spark, table)
    for name in ("marts", "cube"):  # also what an earlier call left behind
        for n in list_folder(spark, f"{table.partials}/{name}"):
            if base is not None and n.isdigit() and int(n) <= base:
                remove_path(spark, f"{table.partials}/{name}/{n}")
    for n in list_folder(spark, table.bases):
        if base is not None and n.isdigit() and int(n) < base:
            remove_path(spark, f"{table.bases}/{n}")
    return base
