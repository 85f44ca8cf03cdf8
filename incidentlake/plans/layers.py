"""Bronze to silver to gold to marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions import (
    clean, clean_upper, double_from_text, is_true_token, not_blank, parse_incident_ts,
    tolerant_int,
)
from ..operators.cleaning import dedupe, drop_missing
from ..operators.explore import frequency
from ..operators.features import flag, with_time_features
from ..operators.shaping import stamp
from ..operators.trends import trend
from ..schema import ISO_FORMAT
from ..sources.readers import read_table
from ..sources.writers import write_table

SILVER_KEY = "crime_id"
SILVER_REQUIRED = ("crime_id", "primary_type")
# the first copy wins; every later column only breaks exact ties
SILVER_ORDER = ("kafka_timestamp", "json_value", "kafka_key")

# Which silver columns get which treatment
_RULES = {
    clean: ("crime_id", "case_number"),
    clean_upper: ("primary_type", "location_description"),
    lambda c: tolerant_int(clean(c)): ("district", "ward", "community_area", "beat", "year"),
    double_from_text: (
        "latitude", "longitude", "x_coordinate", "y_coordinate"),
}

GOLD_TIME_NAMES = (
    "crime_hour", "crime_day_of_week", "crime_month", "is_weekend", "is_night",
)


def typed(bronze: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """Bronze with trimmed, typed columns and a parsed timestamp; no row is dropped."""
    columns = {name: rule(name) for rule, names in _RULES.items() for name in names}
    if blank_as_null:
        for name in SILVER_REQUIRED:
            columns[name] = not_blank(columns[name])
    columns["crime_timestamp"] = parse_incident_ts("date", (ISO_FORMAT,))
    columns["silver_loaded_at"] = F.current_timestamp()
    return bronze.withColumns(columns)


def complete(df: DataFrame) -> DataFrame:
    return drop_missing(df, SILVER_REQUIRED)


def unique(df: DataFrame) -> DataFrame:
    order = [c for c in SILVER_ORDER if c in df.columns] or sorted(
        c for c in df.columns if not c.endswith("_loaded_at"))
    return dedupe(df, [SILVER_KEY], order)


def to_silver(bronze: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """Typed rows with id and type, one per id.

    Trimming keeps a value a value, so missing ones are dropped on the raw columns,
    where the test reaches the reader.
    """
    rows = typed(complete(bronze), blank_as_null)
    return unique(complete(rows) if blank_as_null else rows)


def to_gold(silver: DataFrame) -> DataFrame:
    """Silver with time parts and 0/1 flags; no row is added or dropped."""
    enriched = with_time_features(silver, "crime_timestamp", GOLD_TIME_NAMES).withColumns({
        "arrest_int": flag("arrest", is_true_token),
        "domestic_int": flag("domestic", is_true_token),
    })
    return stamp(enriched, "gold_loaded_at")


def gold_marts(gold: DataFrame) -> dict[str, DataFrame]:
    """The four count tables over gold."""
    return {
        "by_type": frequency(gold, "primary_type"),
        "hourly": trend(gold, "crime_timestamp", "hour"),
        "by_district": frequency(gold, "district"),
        "daily": trend(gold, "crime_timestamp", "day"),
    }


def refine_to_silver(
    spark: SparkSession, bronze_path: str, silver_path: str, fmt: str = "parquet"
) -> dict[str, int]:
    """Build and write silver; returns the row counts of its three steps.

    The counts are observed while the table is written, so they describe the very rows
    it was made of, even if bronze grows meanwhile.
    """
    before, after = Observation(), Observation()
    has_all = F.lit(True)
    for name in SILVER_REQUIRED:
        has_all = has_all & F.col(name).isNotNull()
    bronze = read_table(spark, bronze_path, fmt).observe(
        before, F.count(F.lit(1)).alias("rows_before"), F.count_if(has_all).alias("rows_complete"))
    silver = to_silver(bronze).observe(after, F.count(F.lit(1)).alias("rows_unique"))
    write_table(silver, silver_path, fmt)
    return {**before.get, **after.get}


def refine_to_gold(
    spark: SparkSession, silver_path: str, gold_path: str, fmt: str = "parquet"
) -> str:
    return write_table(to_gold(read_table(spark, silver_path, fmt)), gold_path, fmt)


def write_marts(
    spark: SparkSession, gold_path: str, root: str, fmt: str = "parquet"
) -> dict[str, str]:
    marts = gold_marts(read_table(spark, gold_path, fmt))
    return {n: write_table(df, f"{root}/{n}", fmt) for n, df in marts.items()}
