"""Counts, shares, profiles, histograms and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import is_true_bool, is_true_loose
from ..operators.cleaning import in_bbox, missing_profile
from ..operators.explore import (
    QUANTILE_ACCURACY, busiest_quietest, correlation, distinct_values, filter_top_k, frequency, histogram,
    profile, rate_by, share, top_k, value_range, weekday_hour_matrix,
)
from ..operators.features import feature_table
from ..operators.quantiles import exact_quantiles
from ..plans.findings import CHECKED, CHECKED_NUMERIC, eda_summary
from ..schema import CITY_BOX
from .binding import table, typed_incidents, with_incidents
from .features import FEATURES_B_CTE


EXACT_AT = [0.01, 0.25, 0.5, 0.75, 0.99]


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def row_counts(spark, sf_dir):
    return typed_incidents(spark, sf_dir).agg(F.count("*").alias("rows"))


def type_frequency(spark, sf_dir):
    return frequency(typed_incidents(spark, sf_dir), "primary_type")


def district_frequency(spark, sf_dir):
    return frequency(typed_incidents(spark, sf_dir), "district", drop_null_keys=True)


def district_first_twenty(spark, sf_dir):
    return district_frequency(spark, sf_dir).orderBy("district").limit(20)


def weekday_hour_frequency(spark, sf_dir):
    df = typed_incidents(spark, sf_dir).select(
        F.dayofweek("date_ts").alias("day_of_week"), F.hour("date_ts").alias("hour"))
    return frequency(df, ["day_of_week", "hour"])


def event_type_frequency(spark, sf_dir):
    return frequency(_events(spark, sf_dir), "event_type")


def ranked_types(spark, sf_dir):
    return top_k(typed_incidents(spark, sf_dir), "primary_type", 10)


def ranked_parts(spark, sf_dir):
    return top_k(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], 15)


def leading_type_rows(spark, sf_dir):
    return filter_top_k(typed_incidents(spark, sf_dir), "primary_type", 6).select("id", "primary_type")


def distinct_counts(spark, sf_dir):
    return distinct_values(
        typed_incidents(spark, sf_dir), ["primary_type", "district", "location_description"])


def distinct_order_values(spark, sf_dir):
    return distinct_values(
        table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus", "o_orderdate"], False)


def date_range(spark, sf_dir):
    found = value_range(typed_incidents(spark, sf_dir), F.to_date("date_ts"))
    return found.select(*[F.col(c).cast("string").alias(c) for c in found.columns])


def order_price_range(spark, sf_dir):
    return value_range(table(spark, sf_dir, "orders"), "o_totalprice")


def missing_values(spark, sf_dir):
    return missing_profile(typed_incidents(spark, sf_dir), CHECKED, CHECKED_NUMERIC)


def _missing_sql():
    names = {
        "district": "district_n", "ward": "ward_n", "community_area": "area_n",
        "latitude": "lat", "longitude": "lon",
    }
    parts = [
        f"SELECT '{c}' AS column, count(*) - count({names.get(c, c)}) AS null_count, "
        f"round((count(*) - count({names.get(c, c)})) / count(*) * 100, 2) AS null_pct FROM inc"
        for c in CHECKED
    ]
    return with_incidents("\nUNION ALL\n".join(parts))


_FEATURES = ["hour", "day_of_week", "month", "is_weekend", "is_night", "domestic_numeric",
             "geo_available", "label"]


def feature_profile(spark, sf_dir):
    b = feature_table(typed_incidents(spark, sf_dir), "B")
    found = profile(b, _FEATURES, ["count", "mean", "min", "max"])
    return found.withColumn("mean", F.round("mean", 6))


_PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lineitem_profile(spark, sf_dir):
    found = profile(table(spark, sf_dir, "lineitem"), _PROFILED)
    return found.select("column", "count", *[
        F.round(c, 6).alias(c) for c in ("mean", "stddev", "min", "max")])


QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def lineitem_exact_quantiles(spark, sf_dir):
    """Values at ranks of all measures and of the ship time, by counts in narrowing ranges."""
    found = exact_quantiles(table(spark, sf_dir, "lineitem"), [*_PROFILED, "l_shipdate"], EXACT_AT)
    return found.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def incident_exact_quantiles(spark, sf_dir):
    return exact_quantiles(typed_incidents(spark, sf_dir), ["latitude", "longitude", "beat", "ward"], EXACT_AT)


def lineitem_quartiles(spark, sf_dir):
    """Quartiles of the sketch have a rank within its promised error on every column.

    Spark promises floor((q - e) N) <= rank <= ceil((q + e) N).
    """
    lines = table(spark, sf_dir, "lineitem").select(*_PROFILED)
    found = profile(lines, _PROFILED, list(QUARTILES)).agg(F.map_from_entries(
        F.collect_list(F.struct("column", F.struct(*QUARTILES))))).scalar()
    slack = 1 / QUANTILE_ACCURACY
    checks = []
    for c in _PROFILED:
        for name, q in QUARTILES.items():
            value, rows = found[c][name], F.count(c)
            near = (F.count_if(F.col(c) < value) <= F.ceil((q + slack) * rows)) & (
                F.count_if(F.col(c) <= value) >= F.floor((q - slack) * rows))
            checks.append(F.struct(F.lit(c).alias("column"), F.lit(name).alias("quantile"),
                                   rows.alias("rows"), near.alias("near")))
    return lines.agg(F.array(*checks).alias("c")).select(F.explode("c").alias("c")).select("c.*")


_CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lineitem_correlation(spark, sf_dir):
    return correlation(table(spark, sf_dir, "lineitem"), _CORRELATED) \
        .withColumn("r", F.round("r", 6))


def incident_correlation(spark, sf_dir):
    return correlation(typed_incidents(spark, sf_dir), ["latitude", "longitude", "beat", "ward"]) \
        .withColumn("r", F.round("r", 6))


def _corr_sql(columns, source):
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({columns[a]}, {columns[b]}), 6) AS r FROM {source}"
        for a in columns for b in columns)


def value_histogram(spark, sf_dir):
    found = histogram(_events(spark, sf_dir), "value", 40)
    return found.select("bin", F.round("lower", 6).alias("lower"),
                        F.round("upper", 6).alias("upper"), "count")


def beat_histogram(spark, sf_dir):
    found = histogram(typed_incidents(spark, sf_dir), "beat", 40)
    return found.select("bin", F.round("lower", 6).alias("lower"),
                        F.round("upper", 6).alias("upper"), "count")


def hour_histogram(spark, sf_dir):
    df = typed_incidents(spark, sf_dir).select(F.hour("date_ts").alias("hour"))
    return histogram(df, "hour", 24, value_range=(0, 24)).select("bin", "lower", "upper", "count")


def _histogram_sql(source, x, bins):
    return f"""
v AS (SELECT CAST({x} AS DOUBLE) AS x FROM {source} WHERE {x} IS NOT NULL),
r AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM v),
c AS (SELECT least(CAST(floor((x - lo) / w) AS BIGINT), {bins - 1}) AS bin, count(*) AS n FROM v, r GROUP BY 1)
SELECT CAST(range AS INT) AS bin, round(lo + range * w, 6) AS lower,
  round(lo + (range + 1) * w, 6) AS upper, COALESCE(n, 0) AS count
FROM range({bins}) CROSS JOIN r LEFT JOIN c ON c.bin = range"""


def day_extremes(spark, sf_dir):
    found = busiest_quietest(typed_incidents(spark, sf_dir), "date_ts")
    return found.select(
        F.col("busiest_day").cast("string").alias("busiest_day"), "busiest_count",
        F.col("quietest_day").cast("string").alias("quietest_day"), "quietest_count",
        F.round("mean_per_day", 6).alias("mean_per_day"))


def weekday_hour_grid(spark, sf_dir):
    return weekday_hour_matrix(typed_incidents(spark, sf_dir), "date_ts")


def _matrix_sql():
    cells = ", ".join(
        f"count(*) FILTER (WHERE date_ts IS NOT NULL AND hour(date_ts) = {h}) AS h{h:02d}" for h in range(24))
    return with_incidents(f"""
WITH days AS (SELECT * FROM (VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'),
  (4, 'Thursday'), (5, 'Friday'), (6, 'Saturday'), (7, 'Sunday')) t(position, day))
SELECT position, day, {cells} FROM days LEFT JOIN inc ON dayname(date_ts) = day GROUP BY ALL""")


def shares(spark, sf_dir):
    df = typed_incidents(spark, sf_dir)
    parts = [
        share(df, is_true_bool(c)).select(F.lit(c).alias("flag"), "rows", "matching",
                                          F.round("pct", 6).alias("pct"))
        for c in ("arrest", "domestic")
    ]
    return parts[0].unionByName(parts[1])


def return_rate_by_status(spark, sf_dir):
    found = rate_by(table(spark, sf_dir, "lineitem"), "l_linestatus",
                    F.col("l_returnflag") == "R", mark_above=True)
    return found.select("l_linestatus", "count", F.round("rate_pct", 6).alias("rate_pct"),
                        F.round("mean_pct", 6).alias("mean_pct"), "above_mean")


def arrest_rate_rounded(spark, sf_dir):
    """The rate list with one decimal, where the mean is over the rounded rates."""
    return rate_by(typed_incidents(spark, sf_dir), "primary_type", is_true_loose("arrest"),
                   k=10, digits=1).select("primary_type", "count", "rate_pct")


def bounding_box(spark, sf_dir):
    return in_bbox(typed_incidents(spark, sf_dir), "latitude", "longitude").select("id")


def findings(spark, sf_dir):
    return eda_summary(typed_incidents(spark, sf_dir))


def _findings_sql():
    def top(dim, alias, extra="", k=1, order="n DESC"):
        return (f"{alias} AS (SELECT CAST(v AS VARCHAR) AS v, n, row_number() OVER (ORDER BY {order}, v) AS r FROM "
                f"(SELECT {dim} AS v, count(*) AS n FROM inc WHERE {dim} IS NOT NULL {extra} GROUP BY 1) "
                f"QUALIFY r <= {k})")

    day = "strftime(date_ts, '%Y-%m-%d')"
    return with_incidents(f"""
WITH {top('primary_type', 'k')}, {top("strftime(date_ts, '%H:00')", 'h', k=2)}, {top(day, 'd')},
{top(day, 'q', order='n')}, {top('district_n', 's', k=3)},
{top('location_description', 'l')},
m AS (SELECT "column" AS c, null_pct FROM ({_missing_sql().split('AS date_ts FROM iso)', 1)[1]})
  ORDER BY null_count DESC, c LIMIT 1),
t AS (SELECT count(*) AS n, min(year(date_ts)) AS y0, max(year(date_ts)) AS y1,
  count(*) FILTER (WHERE arrest_b) AS a, count(*) FILTER (WHERE domestic_b) AS dv FROM inc)
SELECT 1 AS position, 'Record count' AS finding, n || ' rows' AS detail FROM t
UNION ALL SELECT 2, 'Years in sample', y0 || '-' || y1 FROM t
UNION ALL SELECT 3, 'Busiest calendar day', v || ' (' || n || ' incidents)' FROM d
UNION ALL SELECT 4, 'Quietest calendar day', v || ' (' || n || ' incidents)' FROM q
UNION ALL SELECT 5, 'Most common crime', k.v || ' (' || k.n || ' incidents, ' ||
  round(100.0::DOUBLE * k.n / t.n, 1)::DOUBLE || '% of rows)' FROM k, t
UNION ALL SELECT 6, 'Peak hours', string_agg(v, ', ' ORDER BY r) FROM h
UNION ALL SELECT 7, 'Highest-crime districts', string_agg(v, ', ' ORDER BY r) FROM s
UNION ALL SELECT 8, 'Arrest rate', round(100.0::DOUBLE * a / n, 1) || '% (' || a || ' incidents)' FROM t
UNION ALL SELECT 9, 'Domestic flag', round(100.0::DOUBLE * dv / n, 1) || '% (' || dv || ' incidents)' FROM t
UNION ALL SELECT 10, 'Most common location', v || ' (' || n || ' incidents)' FROM l
UNION ALL SELECT 11, 'Largest missingness', c || ' - ' || null_pct || '% null' FROM m""")


_BOX = CITY_BOX
QUERIES = {
    "row_counts": (row_counts, with_incidents("SELECT count(*) AS rows FROM inc")),
    "type_frequency": (type_frequency, with_incidents(
        "SELECT primary_type, count(*) AS count FROM inc GROUP BY 1")),
    "district_frequency": (district_frequency, with_incidents(
        "SELECT district_n AS district, count(*) AS count FROM inc WHERE district_n IS NOT NULL GROUP BY 1")),
    "district_first_twenty": (district_first_twenty, with_incidents(
        "SELECT district_n AS district, count(*) AS count FROM inc WHERE district_n IS NOT NULL "
        "GROUP BY 1 ORDER BY 1 LIMIT 20")),
    "weekday_hour_frequency": (weekday_hour_frequency, with_incidents(
        "SELECT dayofweek(date_ts) + 1 AS day_of_week, hour(date_ts) AS hour, count(*) AS count "
        "FROM inc GROUP BY 1, 2")),
    "event_type_frequency": (event_type_frequency,
                             "SELECT event_type, count(*) AS count FROM events GROUP BY 1"),
    "top_types": (ranked_types, with_incidents(
        "SELECT primary_type, count(*) AS count FROM inc GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")),
    "top_part_suppliers": (ranked_parts, """
SELECT l_partkey, l_suppkey, count(*) AS count FROM lineitem GROUP BY 1, 2
ORDER BY 3 DESC, 1, 2 LIMIT 15"""),
    "filter_top_types": (leading_type_rows, with_incidents("""
WITH t AS (SELECT primary_type AS p FROM inc GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 6)
SELECT id, primary_type FROM inc WHERE primary_type IN (SELECT p FROM t)""")),
    "distinct_values": (distinct_counts, with_incidents("""
SELECT 'primary_type' AS column, count(DISTINCT primary_type) + max((primary_type IS NULL)::INT) AS distinct_values FROM inc
UNION ALL SELECT 'district', count(DISTINCT district_n) + max((district_n IS NULL)::INT) FROM inc
UNION ALL SELECT 'location_description', count(DISTINCT location_description) + max((location_description IS NULL)::INT) FROM inc""")),
    "distinct_order_values": (distinct_order_values, """
SELECT 'o_custkey' AS column, count(DISTINCT o_custkey) AS distinct_values FROM orders
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) FROM orders"""),
    "date_range": (date_range, with_incidents(
        "SELECT strftime(min(date_ts), '%Y-%m-%d') AS min_value, "
        "strftime(max(date_ts), '%Y-%m-%d') AS max_value FROM inc")),
    "order_price_range": (order_price_range, "SELECT min(o_totalprice) AS min_value, max(o_totalprice) AS max_value FROM orders"),
    "missing_values": (missing_values, _missing_sql()),
    "feature_profile": (feature_profile, with_incidents(
        f"WITH {FEATURES_B_CTE}\n" + "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column, count({c})::DOUBLE AS count, round(avg({c}), 6) AS mean, "
            f"min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM table_b"
            for c in _FEATURES))),
    "lineitem_profile": (lineitem_profile, "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, count({c})::DOUBLE AS count, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min, round(max({c}), 6) AS max "
        "FROM lineitem" for c in _PROFILED)),
    "lineitem_quartiles": (lineitem_quartiles, "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, '{q}' AS quantile, count({c}) AS rows, true AS near FROM lineitem"
        for c in _PROFILED for q in QUARTILES)),
    "lineitem_exact_quantiles": (lineitem_exact_quantiles, "\nUNION ALL\n".join(
        f"SELECT {p}::DOUBLE AS probability, " + ", ".join(f"quantile_disc({c}, {p}) AS {c}" for c in _PROFILED)
        + f", strftime(quantile_disc(l_shipdate, {p}), '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate FROM lineitem" for p in EXACT_AT)),
    "incident_exact_quantiles": (incident_exact_quantiles, with_incidents("\nUNION ALL\n".join(
        f"SELECT {p}::DOUBLE AS probability, quantile_disc(lat, {p}) AS latitude, quantile_disc(lon, {p}) AS longitude, "
        f"quantile_disc(beat_n, {p}) AS beat, quantile_disc(ward_n, {p}) AS ward FROM inc" for p in EXACT_AT))),
    "lineitem_correlation": (lineitem_correlation, _corr_sql({c: c for c in _CORRELATED}, "lineitem")),
    "incident_correlation": (incident_correlation, with_incidents(_corr_sql(
        {"latitude": "lat", "longitude": "lon", "beat": "beat_n", "ward": "ward_n"}, "inc"))),
    "value_histogram": (value_histogram, "WITH" + _histogram_sql("events", "value", 40)),
    "beat_histogram": (beat_histogram, with_incidents("WITH " + _histogram_sql("inc", "beat_n", 40).strip())),
    "hour_histogram": (hour_histogram, with_incidents("""
SELECT CAST(range AS INT) AS bin, range::DOUBLE AS lower, (range + 1)::DOUBLE AS upper, count(id) AS count
FROM range(24) LEFT JOIN inc ON hour(date_ts) = range GROUP BY ALL""")),
    "day_extremes": (day_extremes, with_incidents("""
WITH d AS (SELECT strftime(date_ts, '%Y-%m-%d') AS day, count(*) AS n FROM inc WHERE date_ts IS NOT NULL GROUP BY 1)
SELECT (SELECT day FROM d ORDER BY n DESC, day LIMIT 1) AS busiest_day, max(n) AS busiest_count,
  (SELECT day FROM d ORDER BY n, day LIMIT 1) AS quietest_day, min(n) AS quietest_count,
  round(avg(n), 6) AS mean_per_day FROM d""")),
    "weekday_hour_matrix": (weekday_hour_grid, _matrix_sql()),
    "flag_shares": (shares, with_incidents("""
SELECT 'arrest' AS flag, count(*) AS rows, count(*) FILTER (WHERE arrest_b) AS matching,
  round(100.0::DOUBLE * count(*) FILTER (WHERE arrest_b) / count(*), 6) AS pct FROM inc
UNION ALL SELECT 'domestic', count(*), count(*) FILTER (WHERE domestic_b),
  round(100.0::DOUBLE * count(*) FILTER (WHERE domestic_b) / count(*), 6) FROM inc""")),
    "return_rate_by_status": (return_rate_by_status, """
WITH g AS (SELECT l_linestatus, count(*) AS count,
  100 * avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS r FROM lineitem GROUP BY 1)
SELECT l_linestatus, count, round(r, 6) AS rate_pct, round((SELECT avg(r) FROM g), 6) AS mean_pct,
  r > (SELECT avg(r) FROM g) AS above_mean FROM g"""),
    "arrest_rate_rounded": (arrest_rate_rounded, with_incidents("""
SELECT primary_type, count(*) AS count,
  round(100 * avg(CASE WHEN arrest_loose THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 1) AS rate_pct
FROM inc WHERE primary_type IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")),
    "bounding_box": (bounding_box, with_incidents(
        f"SELECT id FROM inc WHERE lat BETWEEN {_BOX[0]} AND {_BOX[1]} AND lon BETWEEN {_BOX[2]} AND {_BOX[3]}")),
    "eda_summary": (findings, _findings_sql()),
}
