"""Time expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ..schema import ISO_FORMAT, MONTHS, PLAIN_FORMAT, US_FORMAT, WEEKDAYS
from .casts import _col

ALL_FORMATS = (ISO_FORMAT, US_FORMAT, PLAIN_FORMAT)


# Where a format has a character the others lack. Trying a format that does not fit
# costs an exception per row, so each one is only tried on text of its shape.
_MARKS = {ISO_FORMAT: (11, "T"), US_FORMAT: (3, "/"), PLAIN_FORMAT: (11, " ")}


def _attempt(c: Column, fmt: str) -> Column:
    parsed = F.try_to_timestamp(c, F.lit(fmt))
    if fmt not in _MARKS:
        return parsed
    position, mark = _MARKS[fmt]
    return F.when(F.substring(c, position, 1) == mark, parsed)


def parse_incident_ts(c, formats: Sequence[str] = ALL_FORMATS) -> Column:
    """Timestamp by the first format that fits, else NULL."""
    tries = [_attempt(_col(c), f) for f in formats]
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)


def day_name(ts) -> Column:
    """English day name, whatever the JVM locale."""
    names = F.array(*[F.lit(n) for _, n in sorted(WEEKDAYS)])
    return F.get(names, F.dayofweek(_col(ts)) - 1)


def month_abbr(month_number) -> Column:
    return F.get(F.array(*[F.lit(m) for m in MONTHS]), _col(month_number) - 1)


def iso_now() -> Column:
    """Load time as ISO text with its offset."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
