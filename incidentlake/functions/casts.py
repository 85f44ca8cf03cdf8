"""Casts that give NULL on bad input, whether or not ANSI mode is on."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A failing try_cast builds and drops an exception for every bad row, which costs far
# more than the cast. So text that cannot be a number is recognised before the cast.
# A cast trims all white space and control characters, so the shape allows them.
_WHOLE_PART = r"\A[\x00-\x20]*[+-]?(\d+\.?\d*|\.\d+)[\x00-\x20]*\z"


def tolerant_int(c) -> Column:
    """Integer from text or number; ``'1.0'`` is 1, junk and overflow are NULL."""
    c = _col(c)
    return F.when(c.cast("string").rlike(_WHOLE_PART), c.try_cast("double").try_cast("int"))


def tolerant_double(c) -> Column:
    """Double from text or number; junk is NULL."""
    return _col(c).try_cast("double")


def double_from_text(c) -> Column:
    """``tolerant_double`` for text columns, where blank is a common way to be missing."""
    return F.nullif(F.trim(_col(c)), F.lit("")).try_cast("double")


def tolerant_bool(c) -> Column:
    return _col(c).try_cast("boolean")


def numeric_or_zero(c) -> Column:
    return F.coalesce(tolerant_double(c), F.lit(0.0))


# Three truth rules are in use; they disagree on 't', 'yes', '1' and ' true '.

def is_true_token(c) -> Column:
    """True for the word ``true`` in any case, padded or not."""
    return F.coalesce(F.lower(F.trim(_col(c))) == "true", F.lit(False))


def is_true_bool(c) -> Column:
    """True for everything SQL casts to boolean true."""
    return F.coalesce(tolerant_bool(c), F.lit(False))


def is_true_loose(c) -> Column:
    """True for ``true`` in any case or ``1``, unpadded."""
    return F.coalesce(F.lower(_col(c).cast("string")).isin("true", "1"), F.lit(False))


def is_missing(c, numeric: bool = False) -> Column:
    """NULL, and for numeric columns also NaN."""
    c = _col(c)
    return c.isNull() | F.isnan(c) if numeric else c.isNull()
