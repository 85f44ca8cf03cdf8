"""Messages to two sinks: what parses goes to bronze, the rest to a quarantine with its reason and place in the source.

Every micro-batch writes a folder of its number in both tables, and writing it again replaces it, so a batch that is delivered twice
after a crash counts once. The stream never stops for a bad message. A repaired message is put back by its place: ``replay``
writes what now parses into bronze and notes the place, and a place that is noted is open no more. So at any time bronze and the open
quarantine hold every message of the source exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from ..schema import EVENT_SCHEMA
from ..sources.writers import list_folder, path_exists
from .ingest import read_events

#: Where a message lies in its source: file or topic and partition, then row or offset.
PLACE = ("source", "place")
_BROKEN = "_broken"


def _placed(spark: SparkSession, source: str, options: dict) -> DataFrame:
    """Decoded messages with their place."""
    if source == "kafka":
        settings = {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "100000000", **options}
        messages = spark.readStream.format("kafka").options(**settings).load()
        where = [F.concat_ws("/", "topic", F.col("partition").cast("string")), F.col("offset")]
    else:
        messages = read_events(spark, source, **options)
        where = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"), F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("json_value"), *[w.alias(n) for w, n in zip(where, PLACE, strict=True)])


def _reason(value: Column, broken: Column) -> Column:
    """Why a message is no event; NULL if it is one."""
    text = F.regexp_replace(value, r"^\s+", "")
    return (
        F.when(value.isNull(), "no value")
        .when(text == "", "blank value")
        .when(~text.startswith("{"), "not an object")
        .when(broken.isNotNull(), "not valid JSON")
    )


def parse_checked(messages: DataFrame, schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """Bronze columns and the ``reason`` of messages that are no events.

    An object with fields missing or of its own is an event; a value that does not fit its field's type makes the message broken.
    """
    checked = StructType([*schema.fields]).add(_BROKEN, StringType())
    fields = F.from_json("json_value", checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    parsed = messages.withColumn("_fields", fields)
    return parsed.select(
        *messages.columns, *[F.col(f"_fields.`{f.name}`") for f in schema.fields],
        F.current_timestamp().alias("bronze_loaded_at"), _reason(F.col("json_value"), F.col(f"_fields.{_BROKEN}")).alias("reason"))


def _split(parsed: DataFrame, bronze: str, quarantine: str, part: str) -> None:
    """Write one folder of both tables; both writes replace what an earlier try left."""
    parsed = parsed.persist()
    try:
        good = parsed.filter("reason IS NULL").drop("reason")
        good.write.mode("overwrite").parquet(f"{bronze}/batch={part}")
        bad = parsed.filter("reason IS NOT NULL").select("kafka_key", "kafka_timestamp", "json_value", *PLACE, "reason")
        bad.write.mode("overwrite").parquet(f"{quarantine}/messages/batch={part}")
    finally:
        parsed.unpersist()


def ingest_checked(
    spark: SparkSession, bronze: str, quarantine: str, checkpoint: str, source: str = "files",
    schema: StructType = EVENT_SCHEMA, wait: bool = True, **options: str,
):
    """Take what is new in the source into bronze and quarantine, then stop. The tables belong to one checkpoint."""
    def take(batch: DataFrame, number: int) -> None:
        _split(parse_checked(batch, schema), bronze, quarantine, f"{number:09d}")

    query = _placed(spark, source, options).writeStream.foreachBatch(take) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def read_checked(spark: SparkSession, bronze: str) -> DataFrame:
    """All of bronze; ``batch`` says how a row came in."""
    rows = spark.read.parquet(bronze)
    return rows.withColumn("batch", F.col("batch").cast("string"))


def _replays(spark: SparkSession, quarantine: str) -> list[int]:
    numbers = [int(n) for n in list_folder(spark, f"{quarantine}/replayed") if n.isdigit()]
    return sorted(n for n in numbers if path_exists(spark, f"{quarantine}/replayed/{n}/_SUCCESS"))


def open_messages(spark: SparkSession, quarantine: str, before: int | None = None) -> DataFrame:
    """Messages in quarantine that no replay (with a smaller number) has put back."""
    held = spark.read.parquet(f"{quarantine}/messages").drop("batch")
    numbers = [n for n in _replays(spark, quarantine) if before is None or n < before]
    if not numbers:
        return held
    back = spark.read.parquet(*[f"{quarantine}/replayed/{n}" for n in numbers])
    return held.join(back, list(PLACE), "left_anti")


def replay(
    spark: SparkSession, bronze: str, quarantine: str, repaired: DataFrame, number: int, schema: StructType = EVENT_SCHEMA,
) -> None:
    """Put repaired messages (``source``, ``place``, ``json_value``) back into bronze.

    What still does not parse stays in quarantine as it was, and so does what has no repair. Of several repairs of one place the
    smallest text that parses counts; a place that is not open is left alone. Numbers grow, one replay runs at a time, and a replay
    that is run again with its number and input replaces itself.
    """
    waiting = open_messages(spark, quarantine, before=number).drop("json_value", "reason")
    texts = repaired.select(*PLACE, "json_value")
    found = parse_checked(waiting.join(texts, list(PLACE)).select(
        "kafka_key", "kafka_timestamp", "json_value", *PLACE), schema).filter("reason IS NULL").drop("reason")
    rest = [c for c in found.columns if c not in PLACE]
    # json_value decides alone: everything else of a place is the same or follows from it
    once = found.groupBy(*PLACE).agg(F.min_by(F.struct(*rest), "json_value").alias("row")).select("row.*", *PLACE)
    target = f"{bronze}/batch=replay-{number:09d}"
    once.select(*found.columns).write.mode("overwrite").parquet(target)
    spark.read.schema(once.schema).parquet(target).select(*PLACE).write.mode("overwrite").parquet(f"{quarantine}/replayed/{number}")
