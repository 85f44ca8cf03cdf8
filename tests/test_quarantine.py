"""Two sinks against the messages sent: bronze and open quarantine hold each message once."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from incidentlake.streaming import quarantine as q
from incidentlake.streaming import decode_envelope, ingest_checked, open_messages, parse_events, read_checked, replay

SCHEMA = "key binary, value binary, timestamp timestamp"
AT = dt.datetime(2026, 5, 1)
BAD = {
    None: "no value", "": "blank value", " \n": "blank value", "[1, 2]": "not an object", "word": "not an object",
    "null": "not an object", '{"crime_id": "1"': "not valid JSON", '{"crime_id" "2"}': "not valid JSON",
}


def event(n):
    return json.dumps({"crime_id": str(n), "primary_type": "THEFT", "unknown": n})


def sent(frame, values, path):
    rows = [(b"k", v if v is None else v.encode(), AT) for v in values]
    frame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def lake(tmp_path):
    return {name: str(tmp_path / name) for name in ("inbox", "bronze", "held", "checkpoint")}


def run(spark, lake):
    ingest_checked(spark, lake["bronze"], lake["held"], lake["checkpoint"], path=lake["inbox"], maxFilesPerTrigger="1")


def values(df):
    return sorted((r[0] for r in df.select("json_value").collect()), key=str)


def test_reasons_and_both_sinks(spark, frame, lake):
    good = [event(n) for n in range(20)] + ["{}", '  {"crime_id": null}']
    sent(frame, [*good, *BAD], lake["inbox"])
    run(spark, lake)
    sent(frame, [event(77), "word"], lake["inbox"])  # copies of earlier messages are messages of their own
    run(spark, lake)
    bronze, held = read_checked(spark, lake["bronze"]), open_messages(spark, lake["held"])
    assert values(bronze) == sorted([*good, event(77)])
    assert values(held) == sorted([*BAD, "word"], key=str)
    assert {r.json_value: r.reason for r in held.collect()} == BAD
    assert held.select(*q.PLACE).distinct().count() == held.count()
    plain = parse_events(decode_envelope(spark.read.parquet(lake["inbox"]))).filter("crime_id IS NOT NULL")
    shown = [c for c in plain.columns if c != "bronze_loaded_at"]
    events = bronze.filter("crime_id IS NOT NULL")
    assert sorted(map(str, events.select(*shown).collect())) == sorted(map(str, plain.select(*shown).collect()))


def test_crash_between_the_sinks(spark, frame, lake, monkeypatch):
    sent(frame, [event(1), "word"], lake["inbox"])
    split = q._split

    def half(parsed, bronze, quarantine, part):
        parsed.filter("reason IS NULL").drop("reason").write.mode("overwrite").parquet(f"{bronze}/batch={part}")
        raise RuntimeError("driver lost")

    monkeypatch.setattr(q, "_split", half)
    with pytest.raises(Exception, match="driver lost"):
        run(spark, lake)
    monkeypatch.setattr(q, "_split", split)
    run(spark, lake)
    assert values(read_checked(spark, lake["bronze"])) == [event(1)]
    assert values(open_messages(spark, lake["held"])) == ["word"]


def test_replay_is_idempotent(spark, frame, lake):
    sent(frame, [event(0), "a", "b", "c"], lake["inbox"])
    run(spark, lake)
    held = open_messages(spark, lake["held"]).cache()
    fixed = held.filter("json_value <> 'c'").withColumn("json_value", F.concat(F.lit('{"crime_id": "'), "json_value", F.lit('"}')))
    still_bad = held.filter("json_value = 'c'").withColumn("json_value", F.lit("{"))
    repairs = fixed.unionByName(still_bad).unionByName(fixed.withColumn("json_value", F.lit("worse"))) \
        .select("source", "place", "json_value")
    strange = frame([("nowhere", 5, event(9))], "source string, place bigint, json_value string")
    for number in (0, 0, 1):  # again under its number, and again as another one
        replay(spark, lake["bronze"], lake["held"], repairs.unionByName(strange), number)
        assert values(read_checked(spark, lake["bronze"])) == sorted([event(0), '{"crime_id": "a"}', '{"crime_id": "b"}'])
        assert values(open_messages(spark, lake["held"])) == ["c"]
    run(spark, lake)
    assert read_checked(spark, lake["bronze"]).count() + open_messages(spark, lake["held"]).count() == 4


def test_nothing_bad_and_nothing_at_all(spark, frame, lake):
    sent(frame, [event(1)], lake["inbox"])
    run(spark, lake)
    assert open_messages(spark, lake["held"]).count() == 0
    replay(spark, lake["bronze"], lake["held"], frame([], "source string, place bigint, json_value string"), 0)
    assert read_checked(spark, lake["bronze"]).count() == 1
