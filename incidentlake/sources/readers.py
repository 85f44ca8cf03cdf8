"""CSV, table and report scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import parse_incident_ts
from ..operators.shaping import normalize_columns
from ..schema import ISO_FORMAT, US_FORMAT
from .writers import path_exists

# Source names and the layer each one stands for
SOURCE_NAMES = {
    "csv": "csv",
    "delta_silver": "silver", "silver": "silver",
    "delta_gold": "gold", "gold": "gold",
}


def read_incidents_csv(
    spark: SparkSession, path, schema: T.StructType | None = None, infer: bool = False
) -> DataFrame:
    """CSV with a header. All columns are text unless a schema is given.

    Text keeps values such as ``001`` and needs no extra pass; ``infer=True`` asks
    Spark to guess types instead, which reads the files twice.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def load_source(
    spark: SparkSession, kind: str, paths: dict[str, str], fmt: str = "parquet"
) -> DataFrame:
    """Incidents from ``csv``, ``silver`` or ``gold`` with one ``date_ts`` column."""
    layer = SOURCE_NAMES.get(kind.strip().lower())
    if layer is None:
        raise ValueError(f"unknown source {kind!r}; choose from {sorted(SOURCE_NAMES)}")
    if layer == "csv":
        df = normalize_columns(read_incidents_csv(spark, paths["csv"]))
        ts = parse_incident_ts("date", (ISO_FORMAT, US_FORMAT))
    else:
        df = read_table(spark, paths[layer], fmt)
        ts = F.col("crime_timestamp")
    return df.withColumn("date_ts", ts)


def read_first_existing(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The chosen columns of the first CSV that exists; an empty frame if none does."""
    for path in paths:
        if path_exists(spark, path):
            return read_incidents_csv(spark, path).select(*columns)
    empty = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.createDataFrame([], empty)


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    """A report CSV; a missing report is an empty frame."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, schema=schema, header=True)
