"""Bronze to silver as a stream: replays are dropped in state, late rows go to a side table, silver is updated by increments.

Event time is the message time. Exact replays of a message within the watermark are dropped by keyed state (a digest of 128 bits a
message), which Spark evicts once the watermark has passed, so the state is bounded by the messages of one delay and of the batch
that is taken; it lies on the executors' disks, with a bounded cache in their memory. Copies of an incident that differ stay, since
an earlier copy may arrive later; the increment keeps the first by its order. A batch is written to the table's folder while it is taken in.

Rows at or behind the watermark would be lost in a stateful operator. They reach the batch by a second branch without state, are
written to a side table by batch, and are taken into silver like all others. So silver, its marts and its cube equal those of
one batch over all of bronze, whatever came twice or late.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.incremental import CODEC, Bucketed, increment, silver_rows
from ..plans.layers import SILVER_ORDER
from ..sources.writers import list_folder, path_exists, remove_path

EVENT_TIME = "kafka_timestamp"
_STATE = "spark.sql.streaming.stateStore"
#: Where a new stream keeps its state unless the session says otherwise; the default store holds every row of it on the heap.
STATE = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}.rocksdb.maxMemoryUsageMB": "256",  # of an executor, for all partitions of the state
}


def message_digest(key: str) -> Column:
    """128 bits that tell messages apart: the key and everything in the order of first rows."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (key, *SILVER_ORDER)]
    return F.md5(F.concat_ws("|", *[F.concat(F.length(p), F.lit(":"), p) for p in parts]))


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A stream takes these settings when it starts; one that goes on keeps the store its checkpoint names."""
    unset = [name for name in STATE if spark.conf.get(name, None) is None]
    for name in unset:
        spark.conf.set(name, STATE[name])
    try:
        yield
    finally:
        for name in unset:
            spark.conf.unset(name)


def _clock(spark: SparkSession, path: str, before: int) -> DataFrame | None:
    """The latest event time of all batches before a number."""
    known = [int(n) for n in list_folder(spark, path) if n.isdigit() and int(n) < before and path_exists(spark, f"{path}/{n}/_SUCCESS")]
    return spark.read.parquet(f"{path}/{max(known)}") if known else None


def refine_stream(
    spark: SparkSession, bronze: str, table: Bucketed, checkpoint: str, delay: str = "1 day",
    wait: bool = True, **options: str,
):
    """Take what is new in bronze into the silver table and its partial aggregates, then stop.

    ``delay`` is how far behind the latest message a row may be before it counts as late. Late rows lie under
    ``<root>/late/<batch>``. A table belongs to one checkpoint: batches are numbered by it, and a number is taken in once.
    """
    schema = spark.read.parquet(bronze).schema
    messages = spark.readStream.schema(schema).options(**{"maxFilesPerTrigger": "1000", **options}).parquet(bronze)
    timed = silver_rows(messages).withWatermark(EVENT_TIME, delay)
    once = timed.withColumn("_message", message_digest(table.key)).dropDuplicatesWithinWatermark(["_message"]).drop("_message")
    both = once.withColumn("_raw", F.lit(False)).unionByName(timed.withColumn("_raw", F.lit(True)))
    clock = f"{table.root}/clock"

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        before = _clock(session, clock, number)
        at = None if before is None else before.first().at
        is_late = F.col(EVENT_TIME).isNull()
        if at is not None:  # a millisecond more than the watermark: rows that are in both branches do no harm
            edge = F.lit(at) - F.expr(f"interval {delay}") + F.expr("interval 1 millisecond")
            is_late = is_late | (F.col(EVENT_TIME) <= edge)
        # of the branch without state only late rows are kept; a replay is no later than the message it repeats
        taken = f"{table.root}/taken/{number}"
        batch.filter(~F.col("_raw") | is_late).write.mode("overwrite").option("compression", CODEC).parquet(taken)
        try:
            batch = session.read.schema(batch.schema).parquet(taken)
            late = batch.filter("_raw").drop("_raw")
            late.write.mode("overwrite").option("compression", CODEC).parquet(f"{table.root}/late/{number}")
            increment(session, table, batch.filter("not _raw").drop("_raw").unionByName(late), number)
            latest = batch.agg(F.max(EVENT_TIME).alias("at"))
            if at is not None:
                latest = latest.select(F.greatest("at", F.lit(at)).alias("at"))
            latest.write.mode("overwrite").parquet(f"{clock}/{number}")
        finally:
            remove_path(session, taken)

    with _state_on_disk(spark):
        query = both.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def late_rows(spark: SparkSession, table: Bucketed) -> DataFrame | None:
    """Rows that came behind the watermark, with their batch."""
    numbers = [n for n in list_folder(spark, f"{table.root}/late") if n.isdigit()]
    if not numbers:
        return None
    rows = spark.read.parquet(*[f"{table.root}/late/{n}" for n in numbers])
    return rows.withColumn("batch", F.element_at(F.split(F.input_file_name(), "/"), -2).cast("bigint"))
