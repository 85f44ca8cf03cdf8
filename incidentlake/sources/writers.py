"""Table, report, message and model sinks."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.shaping import to_envelope, to_event_record


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names."""
    fs, target = _file_system(spark, path)
    return bool(fs.exists(target))


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, on whatever file system the path names; nothing if it is not there."""
    fs, folder = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


_NO_SUCH_FORMAT = "DATA_SOURCE_NOT_FOUND"


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
    fallback: str | None = None, partition_by: tuple[str, ...] = (),
) -> str:
    """Write a table, by default replacing data and schema; returns the path written.

    With ``fallback``, an unavailable format is replaced and the table goes to
    ``<path>_<fallback>``. Every other error is raised.
    """
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    try:
        writer.save(path)
        return path
    except (PySparkException, Py4JJavaError) as error:
        if fallback is None or _NO_SUCH_FORMAT not in str(error):
            raise
    return write_table(df, f"{path.rstrip('/')}_{fallback}", fallback, mode,
                       partition_by=partition_by)


def write_report(
    df: DataFrame, path: str, order_by: tuple = (), parts: int | None = 1,
    mode: str = "overwrite",
) -> None:
    """A report as CSV with a header, in the frame's column order.

    A report has few rows and goes into one file. With ``order_by`` its rows are
    computed in parallel and only then gathered and sorted. ``parts=None`` leaves
    larger results in as many files as they have partitions.
    """
    if order_by:
        df = df.repartition(1).sortWithinPartitions(*order_by)
    elif parts is not None:
        df = df.repartition(parts)  # a shuffle, so that what is before it keeps its tasks
    df.write.mode(mode).csv(path, header=True)


def publish_events(
    raw: DataFrame, sink: str, target: str, mode: str = "append",
    timestamp: str | None = None, **options: str,
) -> None:
    """Raw rows as keyed JSON messages to a Kafka topic or to envelope files."""
    keep = [timestamp] if timestamp else []
    messages = to_envelope(to_event_record(raw, keep), F.col(timestamp) if timestamp else None)
    if sink == "kafka":
        messages.drop("timestamp").write.format("kafka").options(topic=target, **options).save()
    elif sink == "files":
        messages.write.mode(mode).parquet(target)
    else:
        raise ValueError(f"unknown sink {sink!r}; choose kafka or files")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def layer_counts(spark: SparkSession, layers: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Rows per layer; a layer that is not there has status NOT FOUND."""
    def one(name, path):
        if path_exists(spark, path):
            rows = spark.read.format(fmt).load(path).agg(F.count("*").alias("rows"))
            counted = rows.withColumn("status", F.lit("OK"))
        else:
            counted = spark.range(1).select(
                F.lit(None).cast("bigint").alias("rows"), F.lit("NOT FOUND").alias("status"))
        return counted.select(F.lit(name).alias("layer"), "rows", "status")

    return reduce(DataFrame.unionByName, [one(n, p) for n, p in layers.items()])
