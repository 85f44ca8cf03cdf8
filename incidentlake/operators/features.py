"""Domain feature columns and the three feature tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    clean_upper, is_true_bool, numeric_or_zero, parse_incident_ts, tolerant_bool,
    tolerant_double, tolerant_int,
)
from ..functions.casts import _col
from ..schema import (
    ISO_FORMAT, LISTED_TYPES, LOCATION_RULES, PLAIN_FORMAT, PROPERTY_TYPES,
    SHORT_LOCATION_RULES, US_FORMAT, VIOLENT_TYPES,
)
from .cleaning import drop_missing
from .explore import top_k
from .shaping import pick_col

# --- single columns -----------------------------------------------------------------


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def weekend_flag(day_of_week) -> Column:
    return _flag(_col(day_of_week).isin(1, 7))


def night_flag(hour) -> Column:
    """1 from 22:00 up to and including the 5 o'clock hour; 0 when unknown."""
    h = _col(hour)
    return _flag(~h.between(6, 21))


TIME_NAMES = ("hour", "day_of_week", "month", "is_weekend", "is_night")


def time_features(ts, names: Sequence[str] = TIME_NAMES) -> dict[str, Column]:
    ts = _col(ts)
    values = [
        F.hour(ts), F.dayofweek(ts), F.month(ts),
        weekend_flag(F.dayofweek(ts)), night_flag(F.hour(ts)),
    ]
    return dict(zip(names, values, strict=True))


def with_time_features(df: DataFrame, ts, names: Sequence[str] = TIME_NAMES) -> DataFrame:
    return df.withColumns(time_features(ts, names))


# The group functions look at their text several times. A caller that has cleaned it in
# an earlier projection passes ``cleaned=True``, so it is trimmed and upper-cased once.

def _text(c, cleaned: bool) -> Column:
    return _col(c) if cleaned else clean_upper(c)


def crime_group(primary_type, cleaned: bool = False) -> Column:
    kind = _text(primary_type, cleaned)
    return (
        F.when(kind.isin(VIOLENT_TYPES), "VIOLENT")
        .when(kind.isin(PROPERTY_TYPES), "PROPERTY")
        .otherwise("OTHER")
    )


def with_crime_group_lookup(df: DataFrame, primary_type: str, groups: DataFrame) -> DataFrame:
    """``crime_group`` from a ``(primary_type, crime_group)`` lookup instead of literals.

    The lookup is left to Spark's own size check to broadcast or shuffle.
    """
    lookup = groups.select(
        F.col("primary_type").alias("_kind"), F.col("crime_group").alias("_group")
    )
    return (
        df.withColumn("_key", clean_upper(primary_type))
        .join(lookup, F.col("_key") == F.col("_kind"), "left")
        .withColumn("crime_group", F.coalesce("_group", F.lit("OTHER")))
        .drop("_key", "_kind", "_group")
    )


def type_group(
    primary_type, allowed: Sequence[str] = LISTED_TYPES, cleaned: bool = False
) -> Column:
    kind = _text(primary_type, cleaned)
    return F.when(kind.isin(list(allowed)), kind).otherwise("OTHER")


def with_type_group_top_k(
    df: DataFrame, key: str = "primary_type", k: int = 10, normalise: bool = True
) -> DataFrame:
    """``primary_type_group``: the k most frequent raw values, the rest ``OTHER``.

    The k names come from a one-value subquery (an array of at most k texts), so
    the frame itself is neither joined nor shuffled and nothing visits the driver
    as rows.
    """
    names = top_k(df, key, k, drop_null_keys=True).agg(F.collect_list(key)).scalar()
    shown = clean_upper(key) if normalise else F.col(key)
    return df.withColumn(
        "primary_type_group",
        F.when(F.array_contains(names, F.col(key)), shown).otherwise("OTHER"),
    )


def location_group(location, rules=LOCATION_RULES, cleaned: bool = False) -> Column:
    text = _text(location, cleaned)
    found = F.lit("OTHER")
    for word, group in reversed(rules):  # one CASE: the first rule whose word occurs decides
        found = F.when(text.contains(word), group).otherwise(found)
    return found


def geo_grid(latitude, longitude, digits: int = 2, missing: float | None = 0.0) -> dict[str, Column]:
    """Grid cell of a coordinate; ``missing=None`` keeps unknown cells NULL."""
    lat = F.round(tolerant_double(latitude), digits)
    lon = F.abs(F.round(tolerant_double(longitude), digits))
    if missing is not None:
        lat, lon = F.coalesce(lat, F.lit(missing)), F.coalesce(lon, F.lit(missing))
    return {"lat_grid": lat, "lon_grid_abs": lon}


def with_geo_grid(
    df: DataFrame, latitude: str = "latitude", longitude: str = "longitude",
    digits: int = 2, missing: float | None = 0.0,
) -> DataFrame:
    return df.withColumns(geo_grid(latitude, longitude, digits, missing))


def geo_available(latitude, longitude) -> Column:
    return _flag(_col(latitude).isNotNull() & _col(longitude).isNotNull())


def district_group(district) -> Column:
    return F.coalesce(_col(district).cast("string"), F.lit("UNKNOWN"))


def flag(c, rule: Callable[[Column], Column] = is_true_bool) -> Column:
    """1 or 0 by one of the truth rules; NULL counts as 0."""
    return rule(_col(c)).cast("int")


def binary_label(arrest) -> Column:
    return flag(arrest).cast("double")


def protocol_label(domestic_flag, arrest_flag) -> Column:
    """0 neither, 1 arrest, 2 domestic, 3 both; an unknown flag gives 0."""
    code = _col(domestic_flag) * 2 + _col(arrest_flag)
    return F.coalesce(code.cast("double"), F.lit(0.0))


# --- feature tables --------------------------------------------------------------------

# Feature columns of the tables, in vector order
NUMERIC_A = [
    "hour", "day_of_week", "month", "is_weekend", "is_night", "domestic_numeric",
    "district", "beat", "community_area", "lat_grid", "lon_grid_abs",
]
CATEGORICAL_A = ["primary_type_group", "crime_group", "location_group"]
NUMERIC_B = [
    "hour", "day_of_week", "month", "is_weekend", "is_night", "domestic_numeric",
    "lat_grid", "lon_grid_abs",
]
CATEGORICAL_B = ["primary_type_group", "location_group", "district_group"]
NUMERIC_C = [
    "hour", "day_of_week", "month", "is_weekend", "is_night", "lat_grid",
    "lon_grid_abs", "community_area", "beat_num", "district_num",
]
CATEGORICAL_C = ["primary_type_group", "location_group", "crime_group"]

# Output column order of the tables
COLUMNS_A = [
    "event_ts", "label", "hour", "day_of_week", "month", "is_weekend", "is_night",
    "primary_type_group", "crime_group", "domestic_numeric", "district", "beat",
    "community_area", "location_group", "lat_grid", "lon_grid_abs",
]
COLUMNS_B = [
    "event_ts", "label", "hour", "day_of_week", "month", "is_weekend", "is_night",
    "domestic_numeric", "lat_grid", "lon_grid_abs", "geo_available",
    "primary_type_group", "location_group", "district_group",
]


def _source_ts(df: DataFrame, formats) -> Column:
    if "crime_timestamp" in df.columns:
        return F.col("crime_timestamp")
    return parse_incident_ts(pick_col(df, ["date"]), formats)


def _named(df: DataFrame, field: str) -> str:
    """The frame's column for a field in storage form or in header form."""
    return pick_col(df, [field, field.replace("_", " ")])


def _integer(df: DataFrame, field: str) -> Column:
    """The field as an integer; one that is typed already stays a bare column,
    so a null test on it can reach the reader."""
    name = _named(df, field)
    return F.col(name) if dict(df.dtypes)[name] == "int" else tolerant_int(name)


def _table_a(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    df = df.withColumns({
        "_kind": clean_upper(_named(df, "primary_type")),
        "_place": clean_upper(_named(df, "location_description")),
        "_ts": _source_ts(df, (ISO_FORMAT, US_FORMAT)),
    })
    built = {
        "event_ts": F.col("_ts"),
        "label": binary_label(_named(df, "arrest")),
        "primary_type_group": type_group("_kind", cleaned=True),
        "crime_group": crime_group("_kind", cleaned=True),
        "domestic_numeric": flag(_named(df, "domestic")),
        "location_group": location_group("_place", cleaned=True),
        **{c: _integer(df, c) for c in ("district", "beat", "community_area")},
        **geo_grid(_named(df, "latitude"), _named(df, "longitude")),
    }
    built.update(time_features(built["event_ts"]))
    # label and the text groups always have a value, so only these two can be missing
    rows = df.select(*keep, *[built[c].alias(c) for c in COLUMNS_A])
    return drop_missing(rows, ["event_ts", "district"])


def _table_b(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    df = with_type_group_top_k(df, "primary_type", 10, normalise=False).withColumns({
        "_place": clean_upper("location_description"),
        "_ts": _source_ts(df, (ISO_FORMAT, US_FORMAT, PLAIN_FORMAT)),
    })
    built = {
        "event_ts": F.col("_ts"),
        "label": binary_label("arrest"),
        "domestic_numeric": flag("domestic"),
        "geo_available": geo_available("latitude", "longitude"),
        "primary_type_group": F.col("primary_type_group"),
        "location_group": location_group("_place", SHORT_LOCATION_RULES, cleaned=True),
        "district_group": district_group("district"),
        **geo_grid("latitude", "longitude", missing=None),
    }
    built.update(time_features(built["event_ts"]))
    rows = df.select(*keep, *[built[c].alias(c) for c in COLUMNS_B])
    return drop_missing(
        rows, ["event_ts", "lat_grid", "lon_grid_abs", "primary_type_group"])


def _table_c(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    df = with_type_group_top_k(df, "primary_type", 10)
    parsed = parse_incident_ts("date", (ISO_FORMAT, US_FORMAT))
    ts = F.coalesce("crime_timestamp", parsed) if "crime_timestamp" in df.columns else parsed
    rows = df.withColumns({
        "ts": ts,
        "domestic_flag": tolerant_bool("domestic").cast("int"),
        "arrest_flag": tolerant_bool("arrest").cast("int"),
        "loc_clean": clean_upper("location_description"),
        "_kind": clean_upper("primary_type"),
    }).withColumns({
        "label": protocol_label("domestic_flag", "arrest_flag"),
        **time_features("ts"),
        **geo_grid("latitude", "longitude"),
        "community_area": numeric_or_zero("community_area"),
        "beat_num": numeric_or_zero("beat"),
        "district_num": numeric_or_zero("district"),
        "location_group": location_group("loc_clean", SHORT_LOCATION_RULES, cleaned=True),
        "crime_group": crime_group("_kind", cleaned=True),
    }).drop("_kind")
    # the label always has a value and the time parts are known when the time is
    return drop_missing(rows, ["ts", "lat_grid"])


_TABLES = {"A": _table_a, "B": _table_b, "C": _table_c}


def feature_table(df: DataFrame, variant: str = "A", keep: Sequence[str] = ()) -> DataFrame:
    """Feature table of a variant.

    A: binary label, fixed type list, unknown coordinates as 0.
    B: binary label, most frequent types, rows without coordinates dropped.
    C: all input columns plus the four-class label and its features.
    ``keep`` adds input columns (an id to split on) in front of A and B.
    """
    if variant not in _TABLES:
        raise ValueError(f"unknown feature table {variant!r}; choose from {sorted(_TABLES)}")
    return _TABLES[variant](df, keep)
