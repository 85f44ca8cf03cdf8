"""Sources, sinks, deduplication, paging and sampling over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.cleaning import dedupe
from ..operators.explore import order_by_day
from ..operators.metrics import classification_metrics
from ..operators.sampling import (
    PageIndex, cap_rows, newest_records, next_page, sample_exact, sample_fraction, split,
)
from ..operators.shaping import normalize_columns, select_existing
from ..session import scratch_dir
from ..sources import (
    load_source, log_run, publish_events, read_first_existing, read_incidents_csv, read_report,
    read_runs, read_table, write_report, write_table,
)
from ..streaming import decode_envelope, parse_events
from ..plans.layers import to_silver
from .binding import bronze_rows, incidents, table, with_incidents
from .quality import _PREDICTIONS, _cells

LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def unique_lines(spark, sf_dir):
    """One line per order and line number out of a table where they repeat."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    kept = dedupe(lines, ["l_orderkey", "l_linenumber"], LINE_COLUMNS[2:])
    return kept.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


def latest_ship_per_flag(spark, sf_dir):
    """Deduplication where each of a few keys holds a large part of all rows."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    kept = dedupe(lines, ["l_returnflag"], [
        F.desc("l_shipdate"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linestatus"])
    return kept.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


_FLAG_ORDER = ("l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, "
               "l_extendedprice, l_quantity, l_discount, l_tax, l_linestatus")
_LINES_SHOWN = ", ".join(LINE_COLUMNS[:-1]) + ", strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate"


def _page(share):
    """A page that begins behind a share of all orders, by way of stored range counts."""
    def query(spark, sf_dir):
        orders = table(spark, sf_dir, "orders")
        index = PageIndex.build(orders, "o_orderdate", "o_orderkey")
        page = index.page(orders, 500, int(index.rows * share), ["o_orderkey", "o_orderdate", "o_totalprice"])
        return page.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return query


def first_page(spark, sf_dir):
    page = newest_records(
        table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey", 500, 0, ["o_orderkey", "o_orderdate", "o_totalprice"])
    return page.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def pages_in_a_row(spark, sf_dir):
    """Five pages of orders, each found from the last row of the one before."""
    orders = table(spark, sf_dir, "orders")
    cursor, pages = None, []
    for number in range(5):
        page, cursor = next_page(orders, "o_orderdate", "o_orderkey", 300, cursor, ["o_orderkey", "o_orderdate"])
        pages.append(page.withColumn("page", F.lit(number)))
    return reduce(DataFrame.unionByName, pages).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


PAGES_SQL = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, CAST(n // 300 AS INT) AS page FROM (
  SELECT o_orderkey, orders.o_orderdate, row_number() OVER (ORDER BY orders.o_orderdate DESC, o_orderkey) - 1 AS n FROM orders) WHERE n < 1500"""


def _page_sql(share):
    return f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (ORDER BY orders.o_orderdate DESC, o_orderkey) - 1 - CAST(floor(
  {share}::DOUBLE * count(*) OVER ()) AS BIGINT) BETWEEN 0 AND 499"""


def hash_part_sql(key: str, seed: int, parts: int) -> str:
    """The key's bucket as the sampling operators compute it."""
    return f"(('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 12))::BIGINT % {parts})"


def key_split(spark, sf_dir):
    """The side of every key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    train, test = split(orders.repartition(7), ["o_orderkey"])
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


def capped_rows(spark, sf_dir):
    """The rows that are left when half of them may stay."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    n = orders.count()
    return cap_rows(orders, ["o_orderkey"], n // 2, n)


def exact_sample(spark, sf_dir):
    """The 700 orders with the smallest digests."""
    return sample_exact(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 700)


def chart_sample(spark, sf_dir):
    """About a third of the orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    n = orders.count()
    return sample_fraction(orders, ["o_orderkey"], n // 3, n)


def _csv(spark, sf_dir, pretty=False):
    path = scratch_dir(spark, "csv")
    raw = incidents(spark, sf_dir).drop("ts")
    if pretty:
        raw = raw.toDF(*[c.replace("_", " ").title() for c in raw.columns])
    raw.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def csv_source(spark, sf_dir):
    df = load_source(spark, "csv", {"csv": _csv(spark, sf_dir)})
    return df.select("id", "primary_type", "district", "latitude",
                     F.date_format("date_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date_ts"))


def csv_headers(spark, sf_dir):
    """Header-style names are normalised before anything else sees them."""
    df = normalize_columns(read_incidents_csv(spark, _csv(spark, sf_dir, pretty=True)))
    return select_existing(df, ["id", "case_number", "primary_type", "no_such_column"])


def first_existing_file(spark, sf_dir):
    path = _csv(spark, sf_dir)
    return read_first_existing(spark, [f"{path}-absent", path], ["id", "arrest", "beat"])


def silver_source(spark, sf_dir):
    path = scratch_dir(spark, "silver")
    write_table(to_silver(bronze_rows(spark, sf_dir)), path)
    df = load_source(spark, "delta_silver", {"silver": path})
    return df.select("crime_id", F.date_format("date_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date_ts"))


def table_fallback(spark, sf_dir):
    """A format that is not installed is replaced; overwriting replaces the schema too."""
    path = scratch_dir(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    write_table(orders.select("o_custkey"), f"{path}_parquet")
    written = write_table(
        orders.select("o_orderkey", "o_orderstatus"), path, fmt="not-installed", fallback="parquet")
    return read_table(spark, written).groupBy("o_orderstatus").agg(
        F.count("*").alias("rows"), F.max("o_orderkey").alias("last_key"))


def report_files(spark, sf_dir):
    """A report written and read back, stacked with one that does not exist."""
    path = scratch_dir(spark, "report")
    schema = "model string, label double, prediction double, count bigint"
    write_report(_cells(spark, sf_dir), path)
    return read_report(spark, path, schema).unionByName(
        read_report(spark, f"{path}-absent", schema))


def published_events(spark, sf_dir):
    path = scratch_dir(spark, "topic")
    publish_events(incidents(spark, sf_dir), "files", path, timestamp="ts")
    sent = parse_events(decode_envelope(spark.read.parquet(path)))
    return sent.select("kafka_key", "crime_id", "primary_type", "event_type",
                       F.date_format("kafka_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("sent_at"))


def run_log(spark, sf_dir):
    path = scratch_dir(spark, "runs")
    scores = classification_metrics(_cells(spark, sf_dir), by=["model"])
    for row in scores.collect():  # one row per model
        log_run(spark, path, "flags", row["model"], {"target": "l_returnflag"},
                {"accuracy": round(row["accuracy"], 6)})
    log_run(spark, path, "flags", "Broken", error="x" * 700)
    return read_runs(spark, path).select(
        "experiment", "run", "kind", "key",
        F.when(F.col("key") == "error", F.length("value").cast("string")).otherwise(F.col("value")).alias("value"))


def order_weekdays(spark, sf_dir):
    """Orders per weekday in display order; a day without orders would have the count 0."""
    days = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "EEEE").alias("day")).agg(F.count("*").alias("count"))
    return order_by_day(days)


QUERIES = {
    "dedupe_lines": (unique_lines, f"""
SELECT {_LINES_SHOWN} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(
    'lineitem.' + c for c in LINE_COLUMNS[2:])}) = 1"""),
    "dedupe_hot_keys": (latest_ship_per_flag, f"""
SELECT {_LINES_SHOWN} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY {_FLAG_ORDER.replace(
    'l_shipdate', 'lineitem.l_shipdate')}) = 1"""),
    "newest_page": (first_page, _page_sql(0.0)),
    "pages_in_a_row": (pages_in_a_row, PAGES_SQL),
    "newest_page_middle": (_page(0.4), _page_sql(0.4)),
    "newest_page_deep": (_page(0.99), _page_sql(0.99)),
    "split_by_key": (key_split, f"""
SELECT o_orderkey, o_totalprice, CASE WHEN {hash_part_sql("o_orderkey", 42, 10_000)} < 8000
  THEN 'train' ELSE 'test' END AS side FROM orders"""),
    "cap_rows": (capped_rows, f"""
WITH n AS (SELECT count(*) AS n FROM orders)
SELECT o_orderkey, o_totalprice FROM orders, n
WHERE {hash_part_sql("o_orderkey", 43, 2**31)} < CAST(floor({2**31}::DOUBLE * (n // 2) / n) AS BIGINT)"""),
    "sample_exact": (exact_sample, f"""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY {hash_part_sql("o_orderkey", 42, 2**16)},
  md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 700"""),
    "sample_fraction": (chart_sample, f"""
WITH n AS (SELECT count(*) AS n FROM orders)
SELECT o_orderkey, o_totalprice FROM orders, n
WHERE {hash_part_sql("o_orderkey", 43, 2**31)} < CAST(floor({2**31}::DOUBLE * (n // 3) / n) AS BIGINT)"""),
    "csv_source": (csv_source, with_incidents("""
SELECT id, primary_type, CASE WHEN district <> '' THEN district END AS district, latitude,
  strftime(date_ts, '%Y-%m-%d %H:%M:%S.%f') AS date_ts FROM inc""")),
    "csv_headers": (csv_headers, with_incidents("SELECT id, case_number, primary_type FROM inc")),
    "first_existing_file": (first_existing_file, with_incidents("SELECT id, arrest, beat FROM inc")),
    "silver_source": (silver_source, with_incidents(
        "SELECT id AS crime_id, strftime(iso_ts, '%Y-%m-%d %H:%M:%S.%f') AS date_ts FROM inc")),
    "table_fallback": (table_fallback, """
SELECT o_orderstatus, count(*) AS rows, max(o_orderkey) AS last_key FROM orders GROUP BY 1"""),
    "report_files": (report_files, f"""WITH {_PREDICTIONS}
SELECT model, label, prediction, count(*) AS count FROM p GROUP BY ALL"""),
    "published_events": (published_events, with_incidents("""
SELECT id AS kafka_key, id AS crime_id, primary_type, primary_type AS event_type,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS sent_at FROM inc""")),
    "run_log": (run_log, f"""WITH {_PREDICTIONS}
SELECT 'flags' AS experiment, model AS run, 'param' AS kind, 'target' AS key, 'l_returnflag' AS value FROM mx
UNION ALL SELECT 'flags', model, 'metric', 'accuracy', CAST(round(accuracy, 6) AS VARCHAR) FROM mx
UNION ALL SELECT 'flags', 'Broken', 'param', 'error', '700'"""),
    "weekday_reindex": (order_weekdays, """
WITH days AS (SELECT * FROM (VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'),
  (4, 'Thursday'), (5, 'Friday'), (6, 'Saturday'), (7, 'Sunday')) t(position, day))
SELECT position, day, count(o_orderkey) AS count FROM days LEFT JOIN orders
  ON dayname(o_orderdate) = day GROUP BY ALL"""),
}
