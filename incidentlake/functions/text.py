"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .casts import _col


def clean(c) -> Column:
    return F.trim(_col(c))


def clean_upper(c) -> Column:
    return F.upper(F.trim(_col(c)))


def not_blank(c) -> Column:
    """The value, or NULL when it is an empty string."""
    return F.nullif(_col(c), F.lit(""))


def snake_name(name: str) -> str:
    """Column header in storage form: ``' Case Number'`` is ``case_number``."""
    return name.strip().lower().replace(" ", "_")


def synthetic_user_id(district, beat, ward) -> Column:
    """Stable actor id from where the incident was handled; NULL counts as blank."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in (district, beat, ward)]
    return F.concat(F.lit("user_"), F.substring(F.md5(F.concat_ws("_", *parts)), 1, 10))


def cell_label(lat, lon_abs) -> Column:
    return F.format_string("%.2fN  %.2fW", _col(lat), _col(lon_abs))


# Display replacements, applied in this order
MODEL_NAME_EDITS = [
    ("Classifier", ""),
    ("Regressor", ""),
    ("Regression", " Reg"),
    ("MultilayerPerceptron", "MLP"),
]


def short_model_name(c) -> Column:
    out = _col(c)
    for word, shorter in MODEL_NAME_EDITS:
        out = F.replace(out, F.lit(word), F.lit(shorter))
    return F.trim(out)
