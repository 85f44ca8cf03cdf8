"""Ingest, silver, gold and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.cleaning import clean_audit
from ..operators.shaping import to_envelope, to_event_record
from ..plans.incremental import (
    MARTS, Bucketed, compact, increment, read_counts, read_heatmap, read_rows, silver_rows,
)
from ..plans.layers import (
    SILVER_REQUIRED, gold_marts, refine_to_gold, refine_to_silver, to_gold, to_silver, typed,
)
from ..plans.pruned import DAY, on_days, read_days, write_by_day
from ..schema import EVENT_FIELDS
from ..session import scratch_dir
from ..sources import layer_counts
from ..streaming import (
    decode_envelope, ingest, ingest_checked, late_rows, open_messages, parse_events, read_checked, refine_stream, replay,
)
from .binding import MESSAGES, bronze_rows, incidents, messages, with_incidents


def _text_ts(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


STABLE_FIELDS = [f for f in EVENT_FIELDS if f != "ingest_ts"]


def bronze(spark, sf_dir) -> DataFrame:
    return parse_events(decode_envelope(messages(spark, sf_dir)))


def _show_bronze(df: DataFrame) -> DataFrame:
    return df.select("kafka_key", _text_ts("kafka_timestamp"), *STABLE_FIELDS)


def bronze_parse(spark, sf_dir):
    return _show_bronze(bronze(spark, sf_dir))


def _streamed(spark, sf_dir):
    root = scratch_dir(spark, "ingest")
    inbox, table, checkpoint = f"{root}/inbox", f"{root}/bronze", f"{root}/checkpoint"
    sent = messages(spark, sf_dir)
    first = F.crc32("key") % 2 == 0
    for delivery in (sent.filter(first), sent.filter(~first)):
        delivery.write.mode("append").parquet(inbox)
        ingest(spark, table, checkpoint, path=inbox)
    return table


def bronze_stream(spark, sf_dir):
    """Two deliveries of envelope files, each ingested incrementally."""
    return _show_bronze(spark.read.parquet(_streamed(spark, sf_dir)))


BRONZE_SQL = with_incidents(f"""
WITH {MESSAGES}
SELECT id AS kafka_key, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS kafka_timestamp,
  'user_' || substr(md5(concat_ws('_', district, beat, ward)), 1, 10) AS synthetic_user_id,
  primary_type AS event_type, primary_type, case_number AS related_id, case_number,
  id AS crime_id, date, block, iucr, description, location_description, arrest, domestic,
  beat, district, ward, community_area, fbi_code, x_coordinate, y_coordinate, year,
  updated_on, latitude, longitude
FROM sent""")


def malformed_json(spark, sf_dir):
    """Messages cut in half stay in bronze, with NULL fields."""
    sent = messages(spark, sf_dir).withColumn("value", F.expr("""
        if(cast(cast(key as string) as bigint) % 10 = 3,
           cast(substring(cast(value as string), 1, 40) as binary), value)"""))
    parsed = parse_events(decode_envelope(sent))
    return parsed.agg(
        F.count("*").alias("messages"),
        F.count("crime_id").alias("with_id"),
        F.count_if(F.col("json_value").isNotNull()).alias("with_text"),
    )


def checked_sinks(spark, sf_dir):
    """Messages cut in half go to quarantine; the even ones are repaired and put back, twice."""
    root = scratch_dir(spark, "checked")
    inbox, table, held = f"{root}/inbox", f"{root}/bronze", f"{root}/held"
    messages(spark, sf_dir).write.parquet(f"{root}/whole")
    whole = spark.read.parquet(f"{root}/whole")
    number = F.col("key").cast("string").cast("bigint")
    sent = whole.withColumn("value", F.when(number % 10 > 7, F.expr("substring(value, 1, 40)")).otherwise(F.col("value")))
    for part in range(2):
        sent.filter(F.crc32("key") % 2 == part).write.mode("append").parquet(inbox)
        ingest_checked(spark, table, held, f"{root}/checkpoint", path=inbox)
    repaired = whole.filter(number % 10 == 8).select(
        F.col("key").cast("string").alias("kafka_key"), F.col("value").cast("string").alias("json_value"))
    repairs = open_messages(spark, held).select("kafka_key", "source", "place").join(repaired, "kafka_key").drop("kafka_key")
    repairs.write.parquet(f"{root}/repairs")
    repairs = spark.read.parquet(f"{root}/repairs")  # they do not change while they are put back
    for _ in range(2):
        replay(spark, table, held, repairs, 0)
    taken = read_checked(spark, table).select(
        "kafka_key", "crime_id", F.lit("bronze").alias("sink"), F.lit(None).cast("string").alias("reason"))
    left = open_messages(spark, held).select("kafka_key", F.lit(None).cast("string").alias("crime_id"), F.lit("quarantine").alias("sink"), "reason")
    return taken.unionByName(left)


CHECKED_SQL = with_incidents(f"""
WITH {MESSAGES}
SELECT id AS kafka_key, CASE WHEN CAST(id AS BIGINT) % 10 <> 9 THEN id END AS crime_id,
  CASE WHEN CAST(id AS BIGINT) % 10 = 9 THEN 'quarantine' ELSE 'bronze' END AS sink,
  CASE WHEN CAST(id AS BIGINT) % 10 = 9 THEN 'not valid JSON' END AS reason
FROM sent""")


MALFORMED_SQL = with_incidents(f"""
WITH {MESSAGES}
SELECT count(*) AS messages, count(*) FILTER (WHERE CAST(id AS BIGINT) % 10 <> 3) AS with_id,
  count(*) AS with_text
FROM sent""")


def event_record(spark, sf_dir):
    return to_event_record(incidents(spark, sf_dir).drop("ts")).select(*STABLE_FIELDS)


EVENT_SQL = with_incidents("""
SELECT 'user_' || substr(md5(concat_ws('_', district, beat, ward)), 1, 10) AS synthetic_user_id,
  primary_type AS event_type, primary_type, case_number AS related_id, case_number,
  id AS crime_id, date, block, iucr, description, location_description, arrest, domestic,
  beat, district, ward, community_area, fbi_code, x_coordinate, y_coordinate, year,
  updated_on, latitude, longitude
FROM inc""")


def message_key(spark, sf_dir):
    """The key falls back from a blank id to the case number."""
    raw = incidents(spark, sf_dir).withColumn(
        "id", F.expr("case when cast(id as bigint) % 3 = 0 then '' "
                     "when cast(id as bigint) % 3 = 1 then null else id end"))
    sent = to_envelope(to_event_record(raw.drop("ts")))
    return sent.select(
        F.col("key").cast("string").alias("key"),
        F.get_json_object(F.col("value").cast("string"), "$.case_number").alias("case_number"),
    )


KEY_SQL = with_incidents("""
SELECT CASE WHEN CAST(id AS BIGINT) % 3 = 2 THEN id ELSE case_number END AS key, case_number
FROM inc""")

SILVER_SHOWN = [
    "crime_id", "case_number", "primary_type", "location_description", "district", "ward",
    "community_area", "beat", "year", "latitude", "longitude", "x_coordinate",
    "y_coordinate", "arrest", "domestic",
]


def silver_table(spark, sf_dir):
    return to_silver(bronze_rows(spark, sf_dir)).select(
        *SILVER_SHOWN, _text_ts("crime_timestamp"))


def refined_layers(spark, sf_dir):
    """Messages through all stored layers: stream, bronze, silver, gold; rows of each."""
    bronze_path = _streamed(spark, sf_dir)
    silver_path, gold_path = scratch_dir(spark, "silver"), scratch_dir(spark, "gold")
    refine_to_silver(spark, bronze_path, silver_path)
    refine_to_gold(spark, silver_path, gold_path)
    counts = layer_counts(spark, {
        "bronze": bronze_path, "silver": silver_path, "gold": gold_path,
        "features": f"{gold_path}-absent"})
    return counts


_SILVER_CTE = f"""
WITH {MESSAGES},
silver AS (
  SELECT trim(id) AS crime_id, trim(case_number) AS case_number, kind AS primary_type,
    place AS location_description, district_n AS district, ward_n AS ward,
    area_n AS community_area, beat_n AS beat, CAST(year AS INT) AS year,
    lat AS latitude, lon AS longitude, CAST(x_coordinate AS DOUBLE) AS x_coordinate,
    CAST(y_coordinate AS DOUBLE) AS y_coordinate, arrest, domestic,
    iso_ts AS crime_timestamp
  FROM sent
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts, copy) = 1)"""

_SHOWN_SQL = ", ".join(SILVER_SHOWN) + \
    ", strftime(crime_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS crime_timestamp"


def silver_sql(select: str) -> str:
    return with_incidents(f"{_SILVER_CTE}\n{select}")


def gold_table(spark, sf_dir):
    gold = to_gold(to_silver(bronze_rows(spark, sf_dir)))
    return gold.select(
        *SILVER_SHOWN, _text_ts("crime_timestamp"), "crime_hour", "crime_day_of_week",
        "crime_month", "is_weekend", "is_night", "arrest_int", "domestic_int")


GOLD_SQL = silver_sql(f"""
SELECT {_SHOWN_SQL}, hour(crime_timestamp) AS crime_hour,
  dayofweek(crime_timestamp) + 1 AS crime_day_of_week, month(crime_timestamp) AS crime_month,
  CASE WHEN dayofweek(crime_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour(crime_timestamp) >= 22 OR hour(crime_timestamp) <= 5 THEN 1 ELSE 0 END AS is_night,
  CASE WHEN lower(trim(arrest)) = 'true' THEN 1 ELSE 0 END AS arrest_int,
  CASE WHEN lower(trim(domestic)) = 'true' THEN 1 ELSE 0 END AS domestic_int
FROM silver""")


def silver_audit(spark, sf_dir):
    return clean_audit(typed(bronze_rows(spark, sf_dir)), SILVER_REQUIRED, "crime_id")


AUDIT_SQL = with_incidents(f"""
WITH {MESSAGES}
SELECT count(*) AS rows_before, count(*) FILTER (WHERE id IS NOT NULL AND kind IS NOT NULL) AS rows_complete,
  count(DISTINCT CASE WHEN kind IS NOT NULL THEN id END) AS rows_unique
FROM sent""")


def silver_blank_ids(spark, sf_dir):
    """A third of the ids blank: one hot key by default, missing if asked."""
    rows = bronze_rows(spark, sf_dir).withColumn(
        "crime_id", F.expr("if(cast(crime_id as bigint) % 3 = 0, '  ', crime_id)"))

    def counted(rule, blank_as_null):
        return to_silver(rows, blank_as_null).agg(F.count("*").alias("rows")).select(
            F.lit(rule).alias("rule"), "rows")

    return counted("blank is a value", False).unionByName(counted("blank is missing", True))


BLANK_SQL = with_incidents("""
SELECT 'blank is a value' AS rule, count(*) FILTER (WHERE CAST(id AS BIGINT) % 3 <> 0) + 1 AS rows FROM inc
UNION ALL
SELECT 'blank is missing', count(*) FILTER (WHERE CAST(id AS BIGINT) % 3 <> 0) FROM inc""")


def _mart(name):
    def query(spark, sf_dir):
        mart = gold_marts(to_gold(to_silver(bronze_rows(spark, sf_dir))))[name]
        if name == "daily":
            mart = mart.withColumn("day", F.col("day").cast("string"))
        return mart
    return query


def _mart_sql(column, where=""):
    return silver_sql(f"SELECT {column}, count(*) AS count FROM silver {where} GROUP BY 1")


_DATED = "WHERE crime_timestamp IS NOT NULL"


# --- increments: the same tables without rebuilding them ------------------------------------


def busiest_days_by_district(spark, sf_dir):
    """Districts of the five busiest days, from a silver layer of which only those days are read."""
    root = scratch_dir(spark, "pruned")
    write_by_day(to_silver(bronze_rows(spark, sf_dir)), f"{root}/silver")
    rows = read_days(spark, f"{root}/silver")
    rows.filter(F.col(DAY).isNotNull()).groupBy(DAY).agg(F.count("*").alias("rows")).write.parquet(f"{root}/days")
    busiest = spark.read.parquet(f"{root}/days").orderBy(F.desc("rows"), DAY).limit(5)
    found = on_days(rows, busiest).groupBy(DAY, "district").agg(F.count("*").alias("count"))
    return found.withColumn(DAY, F.col(DAY).cast("string"))


def _incremented(spark, sf_dir) -> Bucketed:
    """Bronze in three increments, second copies first, the last one delivered twice and the second one compacted."""
    table = Bucketed(scratch_dir(spark, "increments"), buckets=16)
    rows = silver_rows(bronze_rows(spark, sf_dir).withColumn("json_value", F.col("arrest")))
    part = F.crc32(F.concat_ws("|", "crime_id", F.col("kafka_timestamp").cast("string"))) % 3
    for number in range(3):
        increment(spark, table, rows.filter(part == number), number)
        if number == 1:
            compact(spark, table)
    increment(spark, table, rows.filter(part == 2), 3)  # delivered again
    return table


def silver_increments(spark, sf_dir):
    return read_rows(spark, _incremented(spark, sf_dir)).select(*SILVER_SHOWN, _text_ts("crime_timestamp"))


def merged_marts(spark, sf_dir):
    """The four marts from partial aggregates, as (mart, key, count)."""
    key = F.coalesce(*[F.col(k).cast("string") for k, _ in MARTS.values()])
    return read_counts(spark, _incremented(spark, sf_dir), "marts").select("mart", key.alias("key"), "count")


def merged_heatmap(spark, sf_dir):
    cells = read_heatmap(spark, _incremented(spark, sf_dir))
    return cells.withColumn("avg_crimes", F.round("avg_crimes", 6))


def silver_stream(spark, sf_dir):
    """Messages streamed to bronze and on to silver, in two deliveries of which the second repeats a part of the first."""
    root = scratch_dir(spark, "stream")
    table = Bucketed(f"{root}/silver", buckets=16)
    sent = messages(spark, sf_dir)
    part = F.crc32(F.concat("key", F.col("timestamp").cast("string"))) % 4
    for delivery in (sent.filter(part < 2), sent.filter(part > 0)):
        delivery.write.mode("append").option("compression", "zstd").parquet(f"{root}/inbox")
        ingest(spark, f"{root}/bronze", f"{root}/to_bronze", path=f"{root}/inbox")
        refine_stream(spark, f"{root}/bronze", table, f"{root}/to_silver", delay="12 hours")
    return read_rows(spark, table).select(*SILVER_SHOWN, _text_ts("crime_timestamp"))


def streamed_late_rows(spark, sf_dir):
    """Incidents of a second delivery that begins half a day before the latest message of the first."""
    root = scratch_dir(spark, "late")
    table = Bucketed(f"{root}/silver", buckets=16)
    rows = bronze_rows(spark, sf_dir).withColumn("json_value", F.col("crime_id"))
    first = F.col("crime_id").cast("bigint") % 2 == 0
    for delivery in (rows.filter(first), rows.filter(~first)):
        delivery.write.mode("append").option("compression", "zstd").parquet(f"{root}/bronze")
        refine_stream(spark, f"{root}/bronze", table, f"{root}/checkpoint", delay="12 hours")
    return late_rows(spark, table).groupBy("crime_id").agg(F.count("*").alias("copies"))


LATE_SQL = with_incidents(f"""
WITH {MESSAGES},
first AS (SELECT max(ts) AS latest FROM sent WHERE CAST(id AS BIGINT) % 2 = 0)
SELECT id AS crime_id, count(*) AS copies FROM sent, first
WHERE CAST(id AS BIGINT) % 2 = 1 AND ts <= latest - INTERVAL 12 HOUR + INTERVAL 1 MILLISECOND GROUP BY 1""")

_MERGED_MARTS = "\nUNION ALL\n".join(
    f"SELECT '{mart}' AS mart, {key} AS key, count(*) AS count FROM silver {where} GROUP BY 2" for mart, key, where in (
        ("by_type", "primary_type", ""), ("hourly", "CAST(hour(crime_timestamp) AS VARCHAR)", _DATED),
        ("by_district", "CAST(district AS VARCHAR)", ""), ("daily", "strftime(crime_timestamp, '%Y-%m-%d')", _DATED)))

QUERIES = {
    "silver_increments": (silver_increments, silver_sql(f"SELECT {_SHOWN_SQL} FROM silver")),
    "silver_stream": (silver_stream, silver_sql(f"SELECT {_SHOWN_SQL} FROM silver")),
    "streamed_late_rows": (streamed_late_rows, LATE_SQL),
    "marts_merged": (merged_marts, silver_sql(_MERGED_MARTS)),
    "heatmap_merged": (merged_heatmap, silver_sql("""
SELECT lat_grid, lon_grid_abs, count(*) AS time_windows, round(avg(n), 6) AS avg_crimes FROM (
  SELECT lat_grid, lon_grid_abs, hour(crime_timestamp) AS h, dayofweek(crime_timestamp) AS d, month(crime_timestamp) AS m, count(*) AS n
  FROM (SELECT *, round(latitude, 2) AS lat_grid, COALESCE(abs(round(longitude, 2)), 0.0) AS lon_grid_abs FROM silver) WHERE latitude IS NOT NULL AND crime_timestamp IS NOT NULL AND lat_grid <> 0
  GROUP BY ALL) GROUP BY ALL""")),
    "event_record": (event_record, EVENT_SQL),
    "message_key": (message_key, KEY_SQL),
    "bronze_parse": (bronze_parse, BRONZE_SQL),
    "bronze_stream": (bronze_stream, BRONZE_SQL),
    "bronze_malformed_json": (malformed_json, MALFORMED_SQL),
    "checked_sinks": (checked_sinks, CHECKED_SQL),
    "silver_table": (silver_table, silver_sql(f"SELECT {_SHOWN_SQL} FROM silver")),
    "refined_layers": (refined_layers, with_incidents(f"""
WITH {MESSAGES}
SELECT 'bronze' AS layer, count(*) AS rows, 'OK' AS status FROM sent
UNION ALL SELECT 'silver', count(*), 'OK' FROM inc
UNION ALL SELECT 'gold', count(*), 'OK' FROM inc
UNION ALL SELECT 'features', NULL, 'NOT FOUND'""")),
    "silver_audit": (silver_audit, AUDIT_SQL),
    "silver_blank_ids": (silver_blank_ids, BLANK_SQL),
    "gold_table": (gold_table, GOLD_SQL),
    "busiest_days_by_district": (busiest_days_by_district, silver_sql("""
SELECT strftime(crime_timestamp, '%Y-%m-%d') AS event_day, district, count(*) AS count FROM silver
WHERE CAST(crime_timestamp AS DATE) IN (
  SELECT CAST(crime_timestamp AS DATE) FROM silver WHERE crime_timestamp IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)
GROUP BY 1, 2""")),
    "mart_by_type": (_mart("by_type"), _mart_sql("primary_type")),
    "mart_hourly": (_mart("hourly"), _mart_sql("hour(crime_timestamp) AS hour", _DATED)),
    "mart_by_district": (_mart("by_district"), _mart_sql("district")),
    "mart_daily": (_mart("daily"), _mart_sql(
        "strftime(crime_timestamp, '%Y-%m-%d') AS day", _DATED)),
}
