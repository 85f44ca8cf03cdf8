"""Schemas of the layers and the fixed values the domain rules are built on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: field lists ------------------------------------------------

RAW_FIELDS = [
    "id", "case_number", "date", "block", "iucr", "primary_type", "description",
    "location_description", "arrest", "domestic", "beat", "district", "ward",
    "community_area", "fbi_code", "x_coordinate", "y_coordinate", "year",
    "updated_on", "latitude", "longitude",
]

EVENT_FIELDS = [
    "ingest_ts", "synthetic_user_id", "event_type", "primary_type", "related_id",
    "case_number", "crime_id", "date", "block", "iucr", "description",
    "location_description", "arrest", "domestic", "beat", "district", "ward",
    "community_area", "fbi_code", "x_coordinate", "y_coordinate", "year",
    "updated_on", "latitude", "longitude",
]

# --- Fixed values: timestamp formats -------------------------------------------

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
US_FORMAT = "MM/dd/yyyy hh:mm:ss a"
PLAIN_FORMAT = "yyyy-MM-dd HH:mm:ss"

# --- Fixed values: category lists ----------------------------------------------

VIOLENT_TYPES = [
    "BATTERY", "ASSAULT", "ROBBERY", "CRIMINAL SEXUAL ASSAULT",
    "SEX OFFENSE", "HOMICIDE", "KIDNAPPING", "STALKING",
    "INTIMIDATION", "HUMAN TRAFFICKING", "OFFENSE INVOLVING CHILDREN",
]

PROPERTY_TYPES = [
    "THEFT", "BURGLARY", "MOTOR VEHICLE THEFT", "CRIMINAL DAMAGE",
    "ARSON", "DECEPTIVE PRACTICE",
]

LISTED_TYPES = [
    "THEFT", "BATTERY", "CRIMINAL DAMAGE", "ASSAULT", "MOTOR VEHICLE THEFT",
    "OTHER OFFENSE", "DECEPTIVE PRACTICE", "BURGLARY", "NARCOTICS",
    "CRIMINAL TRESPASS", "ROBBERY", "WEAPONS VIOLATION",
    "CRIMINAL SEXUAL ASSAULT", "OFFENSE INVOLVING CHILDREN", "SEX OFFENSE",
]

# First matching word decides, so the order is part of the meaning.
LOCATION_RULES = [
    ("STREET", "STREET"),
    ("RESIDENCE", "RESIDENCE"),
    ("APARTMENT", "RESIDENCE"),
    ("SIDEWALK", "STREET"),
    ("PARKING", "PARKING"),
    ("STORE", "STORE"),
    ("SCHOOL", "SCHOOL"),
    ("VEHICLE", "VEHICLE"),
    ("ALLEY", "ALLEY"),
    ("RESTAURANT", "RESTAURANT"),
]
# Feature variants B and C stop after the VEHICLE rule.
SHORT_LOCATION_RULES = LOCATION_RULES[:8]

# --- Fixed values: geography and calendar ---------------------------------------

# (latitude low, latitude high, longitude low, longitude high), ends included
CITY_BOX = (41.60, 42.05, -87.95, -87.50)

# Spark's dayofweek number with its name, in display order
WEEKDAYS = [
    (2, "Monday"), (3, "Tuesday"), (4, "Wednesday"), (5, "Thursday"),
    (6, "Friday"), (7, "Saturday"), (1, "Sunday"),
]

MONTHS = [
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
]

# --- Schemas ----------------------------------------------------------------------


def _strings(names):
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


EVENT_SCHEMA = _strings(EVENT_FIELDS)

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType(), False),
    T.StructField("run", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType(), True),
])

CONFUSION_SCHEMA = "label double, prediction double, count bigint"
HEATMAP_SCHEMA = (
    "lat_grid double, lon_grid_abs double, time_windows bigint, avg_crimes double"
)
