"""Keyed JSON messages into the bronze table, incrementally and exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..schema import ENVELOPE_SCHEMA, EVENT_SCHEMA


def read_events(spark: SparkSession, source: str = "files", **options: str) -> DataFrame:
    """Message stream ``(key, value, timestamp)``.

    ``files`` needs ``path``, a folder of envelope Parquet files. ``kafka`` takes the
    connector's options (``subscribe``, ``kafka.bootstrap.servers``) and starts at
    the earliest offset unless told otherwise. Both bound a batch, so a backlog is worked
    off in steps: ``maxOffsetsPerTrigger`` and ``maxFilesPerTrigger`` set other sizes.
    """
    if source == "kafka":
        settings = {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "100000000", **options}
        stream = spark.readStream.format("kafka").options(**settings).load()
        return stream.select("key", "value", "timestamp")
    if source == "files":
        settings = {"maxFilesPerTrigger": "1000", **options}
        path = settings.pop("path")
        return spark.readStream.schema(ENVELOPE_SCHEMA).options(**settings).parquet(path)
    raise ValueError(f"unknown source {source!r}; choose kafka or files")


def decode_envelope(messages: DataFrame) -> DataFrame:
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("json_value"),
    )


def parse_events(decoded: DataFrame, schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """Bronze rows: the raw JSON next to its fields; malformed JSON has NULL fields."""
    parsed = decoded.withColumn("_fields", F.from_json("json_value", schema))
    return parsed.select(
        *decoded.columns, "_fields.*", F.current_timestamp().alias("bronze_loaded_at")
    )


def write_stream(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", wait: bool = True
):
    """Append everything that is available now, then stop.

    The checkpoint remembers what was read, so the next call adds only new messages.
    """
    query = (
        df.writeStream.format(fmt).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")  # rows hold their JSON text beside its fields
        .trigger(availableNow=True)
        .start(path)
    )
    if wait:
        query.awaitTermination()
    return query


def ingest(
    spark: SparkSession, bronze: str, checkpoint: str, source: str = "files",
    fmt: str = "parquet", **options: str,
):
    """Messages to bronze in one call."""
    messages = read_events(spark, source, **options)
    return write_stream(parse_events(decode_envelope(messages)), bronze, checkpoint, fmt)
