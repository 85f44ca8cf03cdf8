"""Column functions on the awkward values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from incidentlake import functions as fn


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_tolerant_int(frame):
    texts = ["001", " 12 ", "1.0", "-7", "2.9", "", "x", None, "3000000000", "1e3", "+4", "."]
    df = frame([(t,) for t in texts], "s string")
    assert values(df, fn.tolerant_int("s")) == [
        1, 12, 1, -7, 2, None, None, None, None, None, 4, None]


def test_tolerant_int_of_numbers(frame):
    df = frame([(7, 7.9)], "a int, b double")
    assert df.select(fn.tolerant_int("a"), fn.tolerant_int("b")).first()[:] == (7, 7)


def test_doubles(frame):
    df = frame([("41.5",), (" -87.6 ",), ("",), ("  ",), ("x",), (None,)], "s string")
    wanted = [41.5, -87.6, None, None, None, None]
    assert values(df, fn.tolerant_double("s")) == wanted
    assert values(df, fn.double_from_text("s")) == wanted
    assert values(df, fn.numeric_or_zero("s")) == [v or 0.0 for v in wanted]


@pytest.mark.parametrize("text,token,boolean,loose", [
    ("true", True, True, True),
    ("TRUE", True, True, True),
    (" true ", True, True, False),
    ("1", False, True, True),
    ("yes", False, True, False),
    (" t ", False, True, False),
    ("false", False, False, False),
    ("junk", False, False, False),
    ("", False, False, False),
    (None, False, False, False),
])
def test_truth_rules(frame, text, token, boolean, loose):
    row = frame([(text,)], "s string").select(
        fn.is_true_token("s"), fn.is_true_bool("s"), fn.is_true_loose("s")).first()
    assert row[:] == (token, boolean, loose)


def test_timestamp_formats(frame):
    df = frame([
        ("2026-05-01T01:02:03.250",), ("05/01/2026 01:02:03 PM",), ("2026-05-01 01:02:03",),
        ("2026-13-01T00:00:00.000",), ("yesterday",), ("",), (None,),
    ], "s string")
    assert values(df, fn.parse_incident_ts("s")) == [
        dt.datetime(2026, 5, 1, 1, 2, 3, 250000), dt.datetime(2026, 5, 1, 13, 2, 3),
        dt.datetime(2026, 5, 1, 1, 2, 3), None, None, None, None]
    only_iso = values(df, fn.parse_incident_ts("s", ("yyyy-MM-dd'T'HH:mm:ss.SSS",)))
    assert [v is not None for v in only_iso] == [True] + [False] * 6


def test_parse_with_an_own_format(frame):
    df = frame([("01.02.2026",), ("x",)], "s string")
    assert values(df, fn.parse_incident_ts("s", ("dd.MM.yyyy",))) == [
        dt.datetime(2026, 2, 1), None]


def test_text(frame):
    df = frame([("3", "1204", None)], "d string, b string, w string")
    import hashlib

    digest = hashlib.md5(b"3_1204_").hexdigest()[:10]
    assert values(df, fn.synthetic_user_id("d", "b", "w")) == [f"user_{digest}"]
    assert fn.snake_name(" Case Number ") == "case_number"
    labels = frame([(41.88, 87.6)], "a double, b double")
    assert values(labels, fn.cell_label("a", "b")) == ["41.88N  87.60W"]


def test_model_names(frame):
    names = ["LogisticRegression", "GBTClassifier", "MultilayerPerceptron",
             "DecisionTreeRegressor", "GeneralizedLinearRegression"]
    df = frame([(n,) for n in names], "m string")
    assert values(df, fn.short_model_name("m")) == [
        "Logistic Reg", "GBT", "MLP", "DecisionTree", "GeneralizedLinear Reg"]


def test_missing(frame):
    df = frame([(1.0,), (None,), (float("nan"),)], "x double")
    assert values(df, fn.is_missing("x")) == [False, True, False]
    assert values(df, fn.is_missing("x", numeric=True)) == [False, True, True]


def test_names_of_days_and_months(frame):
    df = frame([(dt.datetime(2024, 1, d),) for d in range(1, 8)], "ts timestamp")
    assert values(df, fn.day_name("ts")) == [
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert values(df.limit(1), fn.month_abbr(F.month("ts"))) == ["Jan"]


def test_load_time_has_an_offset(spark):
    stamp = spark.range(1).select(fn.iso_now()).first()[0]
    assert dt.datetime.fromisoformat(stamp).utcoffset() == dt.timedelta(0)


@pytest.mark.parametrize("blank", ["", " ", "\t", "\n", "\r", "\x0b", "\x0c", " \t\n"])
def test_tolerant_int_trims_what_a_cast_trims(frame, blank):
    df = frame([(f"{blank}12{blank}",), (f"12{blank}",), (f"{blank}-3.0",)], "x string")
    found = [tuple(r) for r in df.select(fn.tolerant_int("x"), F.col("x").try_cast("double").cast("int")).collect()]
    assert found == [(12, 12), (12, 12), (-3, -3)]


def test_tolerant_int_keeps_junk_out(frame):
    df = frame([("1 2",), ("12x",), ("",), ("\t",), ("1\n2",), ("99999999999",)], "x string")
    assert [r[0] for r in df.select(fn.tolerant_int("x")).collect()] == [None] * 6
