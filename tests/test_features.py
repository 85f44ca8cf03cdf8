"""Feature columns at their boundaries, and the shape of the feature tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from incidentlake.operators import features as fe
from incidentlake.operators.learning import features_for
from incidentlake.schema import SHORT_LOCATION_RULES


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize("hour,night", [(5, 1), (6, 0), (21, 0), (22, 1), (0, 1), (None, 0)])
def test_night(frame, hour, night):
    assert one(frame([(hour,)], "h int"), fe.night_flag("h")) == [night]


def test_weekend(frame):
    df = frame([(d,) for d in [1, 2, 6, 7, None]], "d int")
    assert one(df, fe.weekend_flag("d")) == [1, 0, 0, 1, 0]


def test_time_features_of_an_unknown_time(frame):
    df = frame([(dt.datetime(2024, 1, 6, 23),), (None,)], "ts timestamp")
    rows = fe.with_time_features(df, "ts").collect()
    assert rows[0][1:] == (23, 7, 1, 1, 1)
    assert rows[1][1:] == (None, None, None, 0, 0)


def test_location_rules_apply_in_order(frame):
    df = frame([(t,) for t in [
        "PARKING LOT / STREET", "Apartment", " sidewalk", "ALLEY", "RESTAURANT", None]], "s string")
    assert one(df, fe.location_group("s")) == [
        "STREET", "RESIDENCE", "STREET", "ALLEY", "RESTAURANT", "OTHER"]
    assert one(df, fe.location_group("s", SHORT_LOCATION_RULES))[3:] == ["OTHER"] * 3


def test_groups(frame):
    df = frame([("  theft ",), ("Homicide",), ("GAMBLING",), (None,)], "s string")
    assert one(df, fe.crime_group("s")) == ["PROPERTY", "VIOLENT", "OTHER", "OTHER"]
    assert one(df, fe.type_group("s")) == ["THEFT", "OTHER", "OTHER", "OTHER"]


def test_lookup_gives_the_same_groups(frame):
    df = frame([(" theft ",), ("HOMICIDE",), ("GAMBLING",), (None,)], "primary_type string")
    groups = frame([("THEFT", "PROPERTY"), ("HOMICIDE", "VIOLENT")],
                   "primary_type string, crime_group string")
    joined = fe.with_crime_group_lookup(df, "primary_type", groups)
    assert joined.filter(F.col("crime_group") != fe.crime_group("primary_type")).count() == 0
    assert joined.count() == 4


def test_most_frequent_types_break_ties_by_name(frame):
    df = frame([(t,) for t in "b b a a c d".split()] + [(None,)] * 5, "primary_type string")
    grouped = fe.with_type_group_top_k(df, k=3, normalise=False)
    kept = {r[0] for r in grouped.select("primary_type_group").distinct().collect()}
    assert kept == {"a", "b", "c", "OTHER"}


def test_grid(frame):
    df = frame([("41.885", "-87.635"), (None, None), ("x", "")], "latitude string, longitude string")
    rows = fe.with_geo_grid(df).select("lat_grid", "lon_grid_abs").collect()
    assert [tuple(r) for r in rows] == [(41.89, 87.64), (0.0, 0.0), (0.0, 0.0)]
    kept = fe.with_geo_grid(df, missing=None).select("lat_grid").collect()
    assert kept[1][0] is None


def test_protocol_label(frame):
    df = frame([(0, 0), (0, 1), (1, 0), (1, 1), (None, 1), (1, None)], "d int, a int")
    assert one(df, fe.protocol_label("d", "a")) == [0.0, 1.0, 2.0, 3.0, 0.0, 0.0]


INCIDENTS = [
    ("1", "2026-05-01T23:00:00.000", " theft ", "STREET", "true", "false", "12", "001", "5",
     "41.88", "-87.63"),
    ("2", "05/02/2026 01:00:00 PM", "BATTERY", None, None, "yes", "13", "2.0", "", None, None),
    ("3", "never", "BATTERY", "ALLEY", "false", "false", "14", "3", "6", "41.0", "-87.0"),
    ("4", "2026-05-01T10:00:00.000", "BATTERY", "STORE", "1", "1", "15", "", "7", "41.0", "-87.0"),
]
SCHEMA = ("crime_id string, date string, primary_type string, location_description string, "
          "arrest string, domestic string, beat string, district string, community_area string, "
          "latitude string, longitude string")


def test_table_a(frame):
    a = fe.feature_table(frame(INCIDENTS, SCHEMA), "A", keep=["crime_id"])
    assert a.columns == ["crime_id", *fe.COLUMNS_A]
    rows = {r["crime_id"]: r for r in a.collect()}
    assert set(rows) == {"1", "2"}  # no time, no district
    assert rows["1"]["label"] == 1.0 and rows["1"]["is_night"] == 1
    assert rows["2"]["district"] == 2 and rows["2"]["community_area"] is None
    assert rows["2"]["lat_grid"] == 0.0 and rows["2"]["domestic_numeric"] == 1


def test_table_a_with_header_style_names(frame):
    renamed = frame(INCIDENTS, SCHEMA).toDF(*[
        c.replace("_", " ").title() for c in frame(INCIDENTS, SCHEMA).columns])
    plain = fe.feature_table(frame(INCIDENTS, SCHEMA), "A").collect()
    assert fe.feature_table(renamed, "A").collect() == plain


def test_table_b_needs_coordinates(frame):
    b = fe.feature_table(frame(INCIDENTS, SCHEMA), "B", keep=["crime_id"])
    assert b.columns == ["crime_id", *fe.COLUMNS_B]
    assert {r["crime_id"] for r in b.collect()} == {"1", "4"}


def test_table_c_keeps_all_columns(frame):
    c = fe.feature_table(frame(INCIDENTS, SCHEMA), "C")
    assert set(SCHEMA.replace(",", "").split()[::2]) <= set(c.columns)
    labels = {r["crime_id"]: r["label"] for r in c.collect()}
    assert labels == {"1": 1.0, "2": 0.0, "4": 3.0}


def test_unknown_variant(frame):
    with pytest.raises(ValueError, match="unknown feature table"):
        fe.feature_table(frame(INCIDENTS, SCHEMA), "Z")


def test_targets_never_see_themselves():
    for target, hidden in {"crime_group": "primary_type_group", "domestic": "domestic_numeric"}.items():
        categorical, numeric = features_for(target)
        assert hidden not in categorical + numeric
    assert sum(map(len, features_for("arrest"))) == 14
