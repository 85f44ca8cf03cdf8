"""Increments against rebuilds: order of arrival, replays, lost drivers, late rows and bounded state."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from incidentlake.operators.density import density_cube, heatmap
from incidentlake.plans import incremental
from incidentlake.plans.incremental import (
    Bucketed, compact, finish, increment, read_counts, read_heatmap, read_mart, read_rows, silver_rows,
)
from incidentlake.plans.layers import gold_marts, to_gold, to_silver
from incidentlake.schema import EVENT_FIELDS
from incidentlake.streaming import decode_envelope, late_rows, parse_events, refine_stream

START = dt.datetime(2026, 5, 1)


def message(number, copy, hour, **fields):
    event = {**dict.fromkeys(EVENT_FIELDS), "crime_id": f"{number}", "primary_type": f"type {number % 3} {copy % 2}",
             "date": (START + dt.timedelta(hours=number % 50)).strftime("%Y-%m-%dT%H:%M:%S.000"), "district": f"{number % 4}",
             "latitude": f"{41.7 + number % 5 / 100}", "longitude": "-87.6", **fields}
    return (b"k", json.dumps(event).encode(), START + dt.timedelta(hours=hour))


@pytest.fixture
def bronze_of(frame):
    def make(messages):
        return parse_events(decode_envelope(frame(messages, "key binary, value binary, timestamp timestamp")))
    return make


def shown(df):
    return sorted(tuple(map(str, r)) for r in df.select(*sorted(c for c in df.columns if c not in ("silver_loaded_at", "bronze_loaded_at", "bucket"))).collect())


def assert_as_rebuilt(spark, table, bronze):
    silver = to_silver(bronze)
    assert shown(read_rows(spark, table)) == shown(silver)
    marts = gold_marts(to_gold(silver))
    for name, mart in marts.items():
        assert sorted(map(tuple, read_mart(spark, table, name).collect()), key=str) == sorted(map(tuple, mart.collect()), key=str)
    cube = density_cube(silver)
    merged = read_counts(spark, table, "cube")
    assert sorted(merged.collect()) == sorted(cube.select(*merged.columns).collect())
    assert shown(read_heatmap(spark, table)) == shown(heatmap(cube))


def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


DELIVERIES = [
    [message(n, 0, 100 + n) for n in range(40)] + [message(1, 1, 90), message(2, 2, 200), message(3, 0, 5, crime_id=None)],
    [message(n, 3, 50 + n) for n in range(30, 60)] + [message(7, 4, 300), message(9, 5, 1), message(61, 0, 9, primary_type=None)],
    [message(n, 0, 100 + n) for n in range(40)] + [message(9, 6, 0, district="x", latitude=None), message(0, 0, 2, crime_id="", date="odd")],
]


def test_increments_equal_a_rebuild(spark, bronze_of, tmp_path):
    table = Bucketed(str(tmp_path / "silver"), buckets=8)
    seen = []
    for number, delivery in enumerate(DELIVERIES):
        seen += delivery
        assert increment(spark, table, silver_rows(bronze_of(delivery)), number)
        assert_as_rebuilt(spark, table, bronze_of(seen))
        assert not increment(spark, table, silver_rows(bronze_of(delivery)), number)  # the same number again
        before = files(table.rows)
        if number == 1:  # rows that are known change nothing
            assert increment(spark, table, silver_rows(bronze_of(seen)), 10)
            assert files(table.rows) == before
            assert compact(spark, table) == 10
            assert_as_rebuilt(spark, table, bronze_of(seen))
            break
    table = Bucketed(str(tmp_path / "other"), buckets=8)
    for number, delivery in enumerate([*DELIVERIES[::-1], []]):  # the other way round, and nothing new
        increment(spark, table, silver_rows(bronze_of(delivery)), number)
    assert_as_rebuilt(spark, table, bronze_of(sum(DELIVERIES, [])))
    assert compact(spark, table) == 3 and compact(spark, table) == 3
    assert_as_rebuilt(spark, table, bronze_of(sum(DELIVERIES, [])))
    with pytest.raises(ValueError, match="not 4 of them"):
        increment(spark, Bucketed(table.root, buckets=4), silver_rows(bronze_of(DELIVERIES[0])), 9)


def test_untouched_buckets_stay(spark, bronze_of, tmp_path):
    table = Bucketed(str(tmp_path / "silver"), buckets=8)
    increment(spark, table, silver_rows(bronze_of(DELIVERIES[0])), 0)
    before = files(table.rows)
    increment(spark, table, silver_rows(bronze_of([message(5, 9, 0)])), 1)
    after = files(table.rows)
    changed = {os.path.dirname(f) for f in before.keys() ^ after.keys()}
    assert len(changed) == 1 and all(after[f] == t for f, t in before.items() if os.path.dirname(f) not in changed)


@pytest.mark.parametrize("lost_in", ["_publish", "_fold", "remove_path", "after_half_a_publish"])
def test_lost_drivers(spark, bronze_of, tmp_path, monkeypatch, lost_in):
    table = Bucketed(str(tmp_path / "silver"), buckets=4)
    increment(spark, table, silver_rows(bronze_of(DELIVERIES[0])), 0)

    def lost(*args):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(incremental, "_fold" if lost_in == "after_half_a_publish" else lost_in, lost)
        with pytest.raises(KeyboardInterrupt):
            increment(spark, table, silver_rows(bronze_of(DELIVERIES[1])), 1)
    if lost_in == "after_half_a_publish":  # a bucket that was cleared and not yet filled
        bucket = sorted(n for n in os.listdir(table.rows) if n.startswith("bucket="))[0]
        for f in os.listdir(f"{table.rows}/{bucket}"):
            os.remove(f"{table.rows}/{bucket}/{f}")
        staged = os.listdir(f"{table.staged}/1/buckets")
        assert bucket in staged
    assert finish(spark, table) == [1]
    assert not increment(spark, table, silver_rows(bronze_of(DELIVERIES[1])), 1)
    assert_as_rebuilt(spark, table, bronze_of(DELIVERIES[0] + DELIVERIES[1]))


def test_lost_while_compacting(spark, bronze_of, tmp_path, monkeypatch):
    table = Bucketed(str(tmp_path / "silver"), buckets=4)
    for number, delivery in enumerate(DELIVERIES):
        increment(spark, table, silver_rows(bronze_of(delivery)), number)
        if number == 0:
            compact(spark, table)

    def lost(*args):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(incremental, "remove_path", lost)
        with pytest.raises(KeyboardInterrupt):
            compact(spark, table)
    assert_as_rebuilt(spark, table, bronze_of(sum(DELIVERIES, [])))
    assert compact(spark, table) == 2
    assert_as_rebuilt(spark, table, bronze_of(sum(DELIVERIES, [])))
    assert os.listdir(f"{table.partials}/cube") == [] and [n for n in os.listdir(table.bases)] == ["2"]


def test_one_scan_for_all_marts(spark, bronze_of, tmp_path):
    table = Bucketed(str(tmp_path / "silver"), buckets=4)
    increment(spark, table, silver_rows(bronze_of(DELIVERIES[0])), 0)
    rows = read_rows(spark, table).withColumn(incremental.SIGN, F.lit(1))
    plan = incremental.mart_counts(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "json_value" not in plan.split("ReadSchema")[1]


def test_streamed_silver(spark, bronze_of, tmp_path):
    """Twenty batches with replays, late and reordered messages: silver of the whole, late rows aside, bounded state."""
    bronze, table = str(tmp_path / "bronze"), Bucketed(str(tmp_path / "silver"), buckets=4)
    sent, totals = [], []
    for batch in range(20):
        new = [message(100 * batch + k, 0, 10 * batch + k % 10) for k in range(25)]
        new += sent[-25:][::3]  # replays of the last delivery
        if batch % 4 == 3:  # far behind, of an incident that is known and of one that is not
            new += [message(100 * batch + 1, 7, 1), message(5000 + batch, 1, 2)]
        sent += new
        bronze_of(new).coalesce(1).write.mode("append").parquet(bronze)
        if batch in (9, 19):  # two runs of the stream; the second goes on where the first has stopped
            query = refine_stream(spark, bronze, table, str(tmp_path / "checkpoint"), delay="20 hours", maxFilesPerTrigger="1")
            totals += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert_as_rebuilt(spark, table, bronze_of(sent))
    late = {r.crime_id for r in late_rows(spark, table).collect()}
    assert {"5007", "5011", "5015", "5019"} <= late and not {str(100 * b + 2) for b in range(20)} & late
    assert max(totals) < 300 < len(sent)
    assert len(totals) >= 20


def test_stream_keeps_state_off_the_heap(spark, bronze_of, tmp_path):
    """The state lies in RocksDB, nothing of a batch stays cached or in the table's folder, and the session is as it was."""
    bronze, table = str(tmp_path / "bronze"), Bucketed(str(tmp_path / "silver"), buckets=4)
    bronze_of(DELIVERIES[0]).write.parquet(bronze)
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    query = refine_stream(spark, bronze, table, str(tmp_path / "checkpoint"))
    state = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"]]
    assert state and all("rocksdbSstFileSize" in s for s in state)
    assert spark.conf.get(name) == before and not os.listdir(f"{table.root}/taken")
    assert_as_rebuilt(spark, table, bronze_of(DELIVERIES[0]))
    given = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(name, given)  # what the session names counts
    try:
        query = refine_stream(spark, bronze, Bucketed(str(tmp_path / "other"), buckets=4), str(tmp_path / "second"))
        assert not any("rocksdbSstFileSize" in p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"])
        assert spark.conf.get(name) == given
    finally:
        spark.conf.unset(name)


def test_open_files_buffer_little(spark, tmp_path, monkeypatch):
    """Row groups get smaller the more buckets a task writes at once."""
    pq = pytest.importorskip("pyarrow.parquet")
    monkeypatch.setattr(incremental, "BUFFERED", 4 << 20)
    table = Bucketed(str(tmp_path / "silver"), buckets=4)
    rows = spark.range(0, 200_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 512).alias("crime_id")).withColumn("bucket", table.bucket())
    incremental._write_buckets(spark, table, rows, table.rows)
    groups = [pq.ParquetFile(f).metadata for f in files(table.rows)]
    assert len(groups) == 4 and all(g.num_row_groups > 1 for g in groups)
    assert sum(g.num_rows for g in groups) == 200_000


def test_increment_shuffles_rows_once(spark, bronze_of, tmp_path, monkeypatch):
    """Whole rows are dealt out once, to find the first of each key; buckets are staged and published without a shuffle."""
    table = Bucketed(str(tmp_path / "silver"), buckets=4)
    increment(spark, table, silver_rows(bronze_of(DELIVERIES[0])), 0)
    plan = incremental._changes(spark, table, silver_rows(bronze_of(DELIVERIES[1])))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 or plan.count("Exchange hashpartitioning") == 1 and "BroadcastExchange" in plan
    staged = []
    monkeypatch.setattr(incremental, "_write_buckets", lambda s, t, rows, path, **o: staged.append(rows))
    incremental._stage(spark, table, silver_rows(bronze_of(DELIVERIES[1])), 1)
    plan = staged[0]._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION" not in plan


def test_null_keys_are_one_key(spark, bronze_of, tmp_path):
    table = Bucketed(str(tmp_path / "silver"), buckets=4)
    rows = silver_rows(bronze_of(DELIVERIES[0])).withColumn("crime_id", F.expr("if(crime_id < '2', null, crime_id)"))
    for number in range(2):
        increment(spark, table, rows.withColumn("kafka_timestamp", F.expr(f"kafka_timestamp - interval {number} hour")), number)
    got = read_rows(spark, table)
    wanted = rows.select("crime_id").distinct().count()
    assert got.count() == wanted and got.filter("crime_id is null").count() == 1
    assert read_mart(spark, table, "by_type").agg(F.sum("count")).first()[0] == wanted
