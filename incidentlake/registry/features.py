"""Scalar functions, feature columns and feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    day_name, is_true_bool, is_true_loose, is_true_token, month_abbr, numeric_or_zero,
    parse_incident_ts, synthetic_user_id, tolerant_double, tolerant_int,
)
from ..operators.explore import frequency
from ..operators.features import (
    COLUMNS_A, COLUMNS_B, crime_group, district_group, feature_table, geo_available,
    location_group, protocol_label, type_group, with_crime_group_lookup, with_geo_grid,
    with_time_features, with_type_group_top_k,
)
from ..schema import (
    LISTED_TYPES, LOCATION_RULES, PROPERTY_TYPES, SHORT_LOCATION_RULES, VIOLENT_TYPES,
)
from .binding import incidents, table, typed_incidents, with_incidents


def _stamp(name):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _sql_list(values):
    return ", ".join(f"'{v}'" for v in values)


GROUP_SQL = f"""CASE WHEN kind IN ({_sql_list(VIOLENT_TYPES)}) THEN 'VIOLENT'
    WHEN kind IN ({_sql_list(PROPERTY_TYPES)}) THEN 'PROPERTY' ELSE 'OTHER' END"""
LISTED_SQL = f"CASE WHEN kind IN ({_sql_list(LISTED_TYPES)}) THEN kind ELSE 'OTHER' END"


def _place_sql(rules):
    cases = " ".join(f"WHEN contains(place, '{w}') THEN '{g}'" for w, g in rules)
    return f"CASE {cases} ELSE 'OTHER' END"


def _time_sql(ts):
    return f"""hour({ts}) AS hour, dayofweek({ts}) + 1 AS day_of_week, month({ts}) AS month,
    CASE WHEN dayofweek({ts}) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour({ts}) >= 22 OR hour({ts}) <= 5 THEN 1 ELSE 0 END AS is_night"""


_GRID_SQL = """COALESCE(round(lat, 2), 0.0) AS lat_grid,
    COALESCE(abs(round(lon, 2)), 0.0) AS lon_grid_abs"""


def timestamp_formats(spark, sf_dir):
    return incidents(spark, sf_dir).select("id", _stamp(parse_incident_ts("date")).alias("parsed"))


def tolerant_casts(spark, sf_dir):
    return incidents(spark, sf_dir).select(
        "id",
        *[tolerant_int(F.trim(c)).alias(f"{c}_int")
          for c in ("district", "ward", "community_area", "arrest")],
        tolerant_double("latitude").alias("latitude"),
        tolerant_double("arrest").alias("arrest_double"),
        numeric_or_zero("district").alias("district_or_zero"),
    )


def truth_rules(spark, sf_dir):
    df = incidents(spark, sf_dir)
    rules = {"token": is_true_token, "bool": is_true_bool, "loose": is_true_loose}
    return df.select("arrest", *[r("arrest").cast("int").alias(n) for n, r in rules.items()]) \
        .groupBy("arrest", *rules).agg(F.count("*").alias("count"))


def calendar_names(spark, sf_dir):
    df = typed_incidents(spark, sf_dir)
    return df.select("id", day_name("date_ts").alias("day"),
                     month_abbr(F.month("date_ts")).alias("month"))


def time_features(spark, sf_dir):
    return with_time_features(typed_incidents(spark, sf_dir), "date_ts").select(
        "id", "hour", "day_of_week", "month", "is_weekend", "is_night")


def shipping_time_features(spark, sf_dir):
    rows = with_time_features(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return frequency(rows, ["day_of_week", "month", "is_weekend", "is_night"])


def category_groups(spark, sf_dir):
    return incidents(spark, sf_dir).select(
        "id", crime_group("primary_type").alias("crime_group"),
        type_group("primary_type").alias("primary_type_group"),
        location_group("location_description").alias("location_group"),
        location_group("location_description", SHORT_LOCATION_RULES).alias("location_short"),
    )


def crime_group_lookup(spark, sf_dir):
    rows = [(k, "VIOLENT") for k in VIOLENT_TYPES] + [(k, "PROPERTY") for k in PROPERTY_TYPES]
    groups = spark.createDataFrame(rows, "primary_type string, crime_group string")
    return with_crime_group_lookup(incidents(spark, sf_dir), "primary_type", groups) \
        .select("id", "crime_group")


def type_group_top_k(spark, sf_dir):
    return with_type_group_top_k(incidents(spark, sf_dir), "primary_type", 10) \
        .select("id", "primary_type_group")


TOP_KINDS = """top_kinds AS (
  SELECT primary_type AS t FROM inc GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)"""


def geo_columns(spark, sf_dir):
    df = typed_incidents(spark, sf_dir)
    return with_geo_grid(df).select(
        "id", "lat_grid", "lon_grid_abs",
        geo_available("latitude", "longitude").alias("geo_available"),
        district_group("district").alias("district_group"))


def protocol_labels(spark, sf_dir):
    flags = {c: F.col(c).try_cast("boolean").cast("int") for c in ("domestic", "arrest")}
    return incidents(spark, sf_dir).select(
        "id", protocol_label(flags["domestic"], flags["arrest"]).alias("label"))


LABEL_SQL = """CASE WHEN arrest IS NULL OR domestic IS NULL THEN 0.0
    ELSE (CASE WHEN domestic_b THEN 2.0 ELSE 0.0 END) + (CASE WHEN arrest_b THEN 1.0 ELSE 0.0 END)
    END"""


def customer_actor_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", synthetic_user_id("c_nationkey", "c_mktsegment", "c_name").alias("user_id"))


def json_properties(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k int")["k"].alias("k"))


def feature_table_a(spark, sf_dir):
    a = feature_table(incidents(spark, sf_dir), "A", keep=["id"])
    return a.select("id", *COLUMNS_A).withColumn("event_ts", _stamp("event_ts"))


FEATURES_A_SQL = with_incidents(f"""
SELECT id, strftime(date_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts,
  CASE WHEN arrest_b THEN 1.0 ELSE 0.0 END::DOUBLE AS label, {_time_sql('date_ts')},
  {LISTED_SQL} AS primary_type_group, {GROUP_SQL} AS crime_group,
  CASE WHEN domestic_b THEN 1 ELSE 0 END AS domestic_numeric,
  district_n AS district, beat_n AS beat, area_n AS community_area,
  {_place_sql(LOCATION_RULES)} AS location_group, {_GRID_SQL}
FROM inc WHERE date_ts IS NOT NULL AND district_n IS NOT NULL""")


def feature_table_b(spark, sf_dir):
    b = feature_table(typed_incidents(spark, sf_dir), "B", keep=["id"])
    return b.select("id", *COLUMNS_B).withColumn("event_ts", _stamp("event_ts"))


_ANY_TS = "COALESCE(iso_ts, us_ts, plain_ts)"
FEATURES_B_CTE = f"""{TOP_KINDS},
dated AS (SELECT *, {_ANY_TS} AS any_ts FROM inc),
table_b AS (SELECT id, strftime(any_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts,
  CASE WHEN arrest_b THEN 1.0 ELSE 0.0 END::DOUBLE AS label, {_time_sql('any_ts')},
  CASE WHEN domestic_b THEN 1 ELSE 0 END AS domestic_numeric,
  round(lat, 2) AS lat_grid, abs(round(lon, 2)) AS lon_grid_abs, 1 AS geo_available,
  CASE WHEN primary_type IN (SELECT t FROM top_kinds) THEN primary_type ELSE 'OTHER' END
    AS primary_type_group,
  {_place_sql(SHORT_LOCATION_RULES)} AS location_group,
  COALESCE(CAST(district_n AS VARCHAR), 'UNKNOWN') AS district_group
FROM dated WHERE any_ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL)"""
FEATURES_B_SQL = with_incidents(f"WITH {FEATURES_B_CTE}\nSELECT * FROM table_b")


def feature_table_c(spark, sf_dir):
    c = feature_table(incidents(spark, sf_dir), "C")
    return c.select(
        "id", _stamp("ts").alias("ts"), "domestic_flag", "arrest_flag", "label", "hour",
        "day_of_week", "month", "is_weekend", "is_night", "lat_grid", "lon_grid_abs",
        "community_area", "beat_num", "district_num", "primary_type_group",
        "location_group", "crime_group")


FEATURES_C_SQL = with_incidents(f"""
WITH {TOP_KINDS}
SELECT id, strftime(date_ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
  CAST(domestic_b AS INT) AS domestic_flag, CAST(arrest_b AS INT) AS arrest_flag,
  {LABEL_SQL}::DOUBLE AS label, {_time_sql('date_ts')}, {_GRID_SQL},
  CAST(area_n AS DOUBLE) AS community_area, CAST(beat_n AS DOUBLE) AS beat_num,
  COALESCE(CAST(district_n AS DOUBLE), 0.0) AS district_num,
  CASE WHEN primary_type IN (SELECT t FROM top_kinds) THEN kind ELSE 'OTHER' END
    AS primary_type_group,
  {_place_sql(SHORT_LOCATION_RULES)} AS location_group, {GROUP_SQL} AS crime_group
FROM inc WHERE date_ts IS NOT NULL""")

QUERIES = {
    "timestamp_formats": (timestamp_formats, with_incidents(
        f"SELECT id, strftime({_ANY_TS}, '%Y-%m-%d %H:%M:%S.%f') AS parsed FROM inc")),
    "tolerant_casts": (tolerant_casts, with_incidents("""
SELECT id, district_n AS district_int, ward_n AS ward_int, area_n AS community_area_int,
  CASE WHEN trim(arrest) = '1' THEN 1 END AS arrest_int, lat AS latitude,
  CASE WHEN trim(arrest) = '1' THEN 1.0 END::DOUBLE AS arrest_double,
  COALESCE(CAST(district_n AS DOUBLE), 0.0) AS district_or_zero
FROM inc""")),
    "truth_rules": (truth_rules, with_incidents("""
SELECT arrest, CASE WHEN lower(trim(arrest)) = 'true' THEN 1 ELSE 0 END AS token,
  CASE WHEN arrest_b THEN 1 ELSE 0 END AS bool, CAST(arrest_loose AS INT) AS loose,
  count(*) AS count
FROM inc GROUP BY ALL""")),
    "calendar_names": (calendar_names, with_incidents(
        "SELECT id, dayname(date_ts) AS day, strftime(date_ts, '%b') AS month FROM inc")),
    "time_features": (time_features, with_incidents(
        f"SELECT id, {_time_sql('date_ts')} FROM inc")),
    "shipping_time_features": (shipping_time_features, """
WITH x AS (SELECT dayofweek(l_shipdate) + 1 AS day_of_week, month(l_shipdate) AS month,
  CASE WHEN dayofweek(l_shipdate) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour(l_shipdate) >= 22 OR hour(l_shipdate) <= 5 THEN 1 ELSE 0 END AS is_night
  FROM lineitem)
SELECT *, count(*) AS count FROM x GROUP BY ALL"""),
    "category_groups": (category_groups, with_incidents(f"""
SELECT id, {GROUP_SQL} AS crime_group, {LISTED_SQL} AS primary_type_group,
  {_place_sql(LOCATION_RULES)} AS location_group,
  {_place_sql(SHORT_LOCATION_RULES)} AS location_short
FROM inc""")),
    "crime_group_lookup": (crime_group_lookup, with_incidents(
        f"SELECT id, {GROUP_SQL} AS crime_group FROM inc")),
    "type_group_top_k": (type_group_top_k, with_incidents(f"""
WITH {TOP_KINDS}
SELECT id, CASE WHEN primary_type IN (SELECT t FROM top_kinds) THEN kind ELSE 'OTHER' END
  AS primary_type_group FROM inc""")),
    "geo_columns": (geo_columns, with_incidents(f"""
SELECT id, {_GRID_SQL}, CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN 1 ELSE 0 END
  AS geo_available, COALESCE(CAST(district_n AS VARCHAR), 'UNKNOWN') AS district_group
FROM inc""")),
    "protocol_labels": (protocol_labels, with_incidents(
        f"SELECT id, {LABEL_SQL}::DOUBLE AS label FROM inc")),
    "customer_actor_ids": (customer_actor_ids, """
SELECT c_custkey, 'user_' || substr(md5(concat_ws('_', c_nationkey, c_mktsegment, c_name)), 1, 10)
  AS user_id FROM customer"""),
    "json_properties": (json_properties, """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"""),
    "feature_table_a": (feature_table_a, FEATURES_A_SQL),
    "feature_table_b": (feature_table_b, FEATURES_B_SQL),
    "feature_table_c": (feature_table_c, FEATURES_C_SQL),
}
