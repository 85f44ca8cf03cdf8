"""The driver's ``events`` table seen as raw incidents, in Spark and in SQL.

Both sides are a plain projection with one incident per event. The values are made
to reach every rule: padded and lower-case categories, all date formats and a bad
date, several spellings of true, NULL flags and missing coordinates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import double_from_text, parse_incident_ts, tolerant_int
from ..operators.shaping import to_envelope, to_event_record

# Skewed by construction: the first names are by far the most frequent.
KINDS = [
    "THEFT", "BATTERY", "CRIMINAL DAMAGE", "ASSAULT", "MOTOR VEHICLE THEFT",
    "OTHER OFFENSE", "DECEPTIVE PRACTICE", "BURGLARY", "NARCOTICS", "ROBBERY",
    "CRIMINAL TRESPASS", "WEAPONS VIOLATION", "OFFENSE INVOLVING CHILDREN",
    "CRIMINAL SEXUAL ASSAULT", "SEX OFFENSE", "STALKING", "ARSON", "HOMICIDE",
    "GAMBLING", "LIQUOR LAW VIOLATION",
]
PLACES = [
    "STREET", "RESIDENCE", "APARTMENT", "SIDEWALK", "PARKING LOT / STREET",
    "PARKING LOT", "SMALL RETAIL STORE", "SCHOOL, PUBLIC", "VEHICLE NON-COMMERCIAL",
    "alley ", "RESTAURANT", None,
]
YES = ["true", "TRUE", " true ", "1", "yes", "t"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(values):
    return "array(" + ", ".join("null" if v is None else f"'{v}'" for v in values) + ")"


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw incidents: the 21 source fields as text, plus the event time ``ts``."""
    kind = f"{_texts(KINDS)}[((event_id % 20) * (event_id % 23)) div 22]"
    yes = f"{_texts(YES)}[event_id % 6]"
    fields = {
        "id": "cast(event_id as string)",
        "case_number": "concat('C', event_id)",
        "date": """case when event_id % 101 = 0 then 'not a date'
            when event_id % 53 = 0 then date_format(ts, 'MM/dd/yyyy hh:mm:ss a')
            when event_id % 59 = 0 then date_format(ts, 'yyyy-MM-dd HH:mm:ss')
            else date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS") end""",
        "block": "concat(user_id, ' MAIN ST')",
        "iucr": "lpad(cast(event_id % 40 as string), 4, '0')",
        "primary_type": f"case when event_id % 7 = 0 then concat('  ', lower({kind}), ' ') else {kind} end",
        "description": "event_type",
        "location_description": f"{_texts(PLACES)}[user_id % 12]",
        "arrest": f"case when event_id % 83 = 0 then null when k < 15 then {yes} else 'false' end",
        "domestic": f"case when event_id % 79 = 0 then null when k % 5 = 0 then {yes} else 'false' end",
        "beat": "cast(user_id as string)",
        "district": "case when event_id % 97 = 0 then '' else lpad(cast(user_id % 22 + 1 as string), 3, '0') end",
        "ward": "concat(user_id % 50, '.0')",
        "community_area": "concat(' ', user_id % 77, ' ')",
        "fbi_code": "lpad(cast(event_id % 26 as string), 2, '0')",
        "x_coordinate": "cast(user_id * 10 as string)",
        "y_coordinate": "cast(user_id * 20 as string)",
        "year": "cast(year(ts) as string)",
        "updated_on": "date_format(ts, 'yyyy-MM-dd')",
        "latitude": "case when event_id % 71 = 0 then null else cast(41.595 + (user_id % 47) / 100D + 0.003 as string) end",
        "longitude": "case when event_id % 71 = 0 then null else cast(-(87.495 + (user_id % 46) / 100D + 0.002) as string) end",
    }
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"),
        F.from_json("props", "k int")["k"].alias("k"),
    )
    return events.selectExpr(*[f"{e} as {n}" for n, e in fields.items()], "ts")


# DuckDB lists start at 1, Spark arrays at 0
def _list(values, index):
    texts = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"([{texts}])[({index}) + 1]"


_KIND = _list(KINDS, "((event_id % 20) * (event_id % 23)) // 22")
_YES = _list(YES, "event_id % 6")

INCIDENTS = f"""
raw AS (
  SELECT event_id, user_id, event_type, ts, CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events),
incidents AS (
  SELECT CAST(event_id AS VARCHAR) AS id, concat('C', event_id) AS case_number,
    CASE WHEN event_id % 101 = 0 THEN 'not a date'
      WHEN event_id % 53 = 0 THEN strftime(ts, '%m/%d/%Y %I:%M:%S %p')
      WHEN event_id % 59 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      ELSE strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%g') END AS date,
    concat(user_id, ' MAIN ST') AS block,
    lpad(CAST(event_id % 40 AS VARCHAR), 4, '0') AS iucr,
    CASE WHEN event_id % 7 = 0 THEN concat('  ', lower({_KIND}), ' ') ELSE {_KIND} END AS primary_type,
    event_type AS description,
    {_list(PLACES, "user_id % 12")} AS location_description,
    CASE WHEN event_id % 83 = 0 THEN NULL WHEN k < 15 THEN {_YES} ELSE 'false' END AS arrest,
    CASE WHEN event_id % 79 = 0 THEN NULL WHEN k % 5 = 0 THEN {_YES} ELSE 'false' END AS domestic,
    CAST(user_id AS VARCHAR) AS beat,
    CASE WHEN event_id % 97 = 0 THEN '' ELSE lpad(CAST(user_id % 22 + 1 AS VARCHAR), 3, '0') END AS district,
    concat(user_id % 50, '.0') AS ward,
    concat(' ', user_id % 77, ' ') AS community_area,
    lpad(CAST(event_id % 26 AS VARCHAR), 2, '0') AS fbi_code,
    CAST(user_id * 10 AS VARCHAR) AS x_coordinate,
    CAST(user_id * 20 AS VARCHAR) AS y_coordinate,
    CAST(year(ts) AS VARCHAR) AS year,
    strftime(ts, '%Y-%m-%d') AS updated_on,
    CASE WHEN event_id % 71 = 0 THEN NULL
      ELSE CAST(41.595::DOUBLE + (user_id % 47) / 100::DOUBLE + 0.003::DOUBLE AS VARCHAR) END AS latitude,
    CASE WHEN event_id % 71 = 0 THEN NULL
      ELSE CAST(-(87.495::DOUBLE + (user_id % 46) / 100::DOUBLE + 0.002::DOUBLE) AS VARCHAR) END AS longitude,
    ts
  FROM raw),
iso AS (
  SELECT *, try_strptime(date, '%Y-%m-%dT%H:%M:%S.%g') AS iso_ts,
    try_strptime(date, '%m/%d/%Y %I:%M:%S %p') AS us_ts,
    try_strptime(date, '%Y-%m-%d %H:%M:%S') AS plain_ts,
    upper(trim(primary_type)) AS kind, upper(trim(location_description)) AS place,
    lower(trim(arrest)) IN ('true', 't', 'yes', 'y', '1') AS arrest_b,
    lower(trim(domestic)) IN ('true', 't', 'yes', 'y', '1') AS domestic_b,
    COALESCE(lower(arrest) IN ('true', '1'), false) AS arrest_loose,
    TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon,
    TRY_CAST(TRY_CAST(trim(district) AS DOUBLE) AS INT) AS district_n,
    TRY_CAST(TRY_CAST(trim(beat) AS DOUBLE) AS INT) AS beat_n,
    TRY_CAST(TRY_CAST(trim(ward) AS DOUBLE) AS INT) AS ward_n,
    TRY_CAST(TRY_CAST(trim(community_area) AS DOUBLE) AS INT) AS area_n
  FROM incidents),
inc AS (SELECT *, COALESCE(iso_ts, us_ts) AS date_ts FROM iso)"""


def with_incidents(sql: str) -> str:
    """SQL that may use ``inc``: raw incidents with parsed helper columns.

    ``kind`` and ``place`` are cleaned texts, ``iso_ts``/``us_ts``/``plain_ts`` the
    date by format, ``date_ts`` the first of ISO and US, ``lat``/``lon`` numbers.
    """
    text = sql.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {INCIDENTS},\n{text[5:]}"
    return f"WITH {INCIDENTS}\n{text}"


def typed_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents with numbers and ``date_ts`` typed, categories as they came."""
    numbers = {c: tolerant_int(F.trim(c)) for c in ("district", "beat", "ward", "community_area")}
    places = {c: double_from_text(c) for c in ("latitude", "longitude")}
    return incidents(spark, sf_dir).withColumns({
        **numbers, **places, "date_ts": parse_incident_ts("date", ("yyyy-MM-dd'T'HH:mm:ss.SSS", "MM/dd/yyyy hh:mm:ss a")),
    })


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All incidents, every tenth one delivered twice.

    The second copy comes an hour later and says the opposite about the arrest, so
    it matters which copy survives.
    """
    raw = incidents(spark, sf_dir)
    again = raw.filter("cast(id as bigint) % 10 = 0").withColumns({
        "arrest": F.expr("if(arrest = 'false', 'true', 'false')"),
        "ts": F.expr("ts + interval 1 hour"),
    })
    return raw.unionByName(again)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries as envelopes with the event time as message time."""
    return to_envelope(to_event_record(deliveries(spark, sf_dir), keep=["ts"]), F.col("ts"))


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries as bronze rows without the detour over JSON text."""
    records = to_event_record(deliveries(spark, sf_dir), keep=["ts"])
    return records.withColumnRenamed("ts", "kafka_timestamp").withColumn(
        "kafka_key", F.col("crime_id"))


MESSAGES = """
sent AS (
  SELECT *, 1 AS copy FROM inc
  UNION ALL BY NAME
  SELECT * REPLACE (CASE WHEN arrest = 'false' THEN 'true' ELSE 'false' END AS arrest,
                    ts + INTERVAL 1 HOUR AS ts), 2 AS copy
  FROM inc WHERE CAST(id AS BIGINT) % 10 = 0)"""
