"""Column functions: tolerant casts, text, time and truth tokens."""

from .casts import (
    double_from_text, is_missing, is_true_bool, is_true_loose, is_true_token, numeric_or_zero,
    tolerant_bool, tolerant_double, tolerant_int,
)
from .text import (
    cell_label, clean, clean_upper, not_blank, short_model_name, snake_name,
    synthetic_user_id,
)
from .time import day_name, iso_now, month_abbr, parse_incident_ts

__all__ = [
    "double_from_text",
    "is_missing", "is_true_bool", "is_true_loose", "is_true_token",
    "numeric_or_zero", "tolerant_bool", "tolerant_double", "tolerant_int",
    "cell_label", "clean", "clean_upper", "not_blank", "short_model_name",
    "snake_name", "synthetic_user_id",
    "day_name", "iso_now", "month_abbr", "parse_incident_ts",
]
