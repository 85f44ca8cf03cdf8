"""Column resolution, header normalisation and other projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import iso_now, not_blank, snake_name, synthetic_user_id
from ..schema import EVENT_FIELDS

# Event fields that are filled from a differently named raw field
RENAMED_FIELDS = {
    "event_type": "primary_type",
    "related_id": "case_number",
    "crime_id": "id",
}


def pick_col(df: DataFrame, candidates: Sequence[str]) -> str:
    """Name of the first candidate the frame has, ignoring case."""
    by_lower = {c.lower(): c for c in df.columns}
    found = next((by_lower[c.lower()] for c in candidates if c.lower() in by_lower), None)
    if found is None:
        raise ValueError(f"no column among {list(candidates)}; available: {df.columns}")
    return found


def normalize_columns(df: DataFrame) -> DataFrame:
    """Headers in storage form; two headers that become equal are an error."""
    names = [snake_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"headers collide after normalisation: {clashes}")
    return df.toDF(*names)


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def stamp(df: DataFrame, name: str) -> DataFrame:
    """Add a load-time column."""
    return df.withColumn(name, F.current_timestamp())


def to_event_record(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw rows as 25-field event records; fields the source lacks are NULL.

    ``keep`` names source columns to carry along, such as the event time.
    """
    df = normalize_columns(df)

    def source(name):
        return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")

    computed = {
        "ingest_ts": iso_now(),
        "synthetic_user_id": synthetic_user_id(
            source("district"), source("beat"), source("ward")
        ),
    }
    return df.select(*[
        computed.get(f, source(RENAMED_FIELDS.get(f, f))).alias(f) for f in EVENT_FIELDS
    ], *keep)


def to_envelope(records: DataFrame, timestamp=None) -> DataFrame:
    """Event records as keyed JSON messages ``(key, value, timestamp)``.

    The key is the incident id, else the case number, else a hash of the record,
    so equal records share a key without any global counter. ``timestamp`` is the
    message time, by default the load time.
    """
    body = F.struct(*EVENT_FIELDS)
    content = [c for c in EVENT_FIELDS if c != "ingest_ts"]
    key = F.coalesce(
        not_blank("crime_id"), not_blank("case_number"),
        F.xxhash64(*content).cast("string"),
    )
    return records.select(
        key.cast("binary").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        (F.current_timestamp() if timestamp is None else timestamp).alias("timestamp"),
    )
