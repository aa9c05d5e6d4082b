"""Calendar functions.  Every operator takes ``as_of``; the clock is only its default."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.config import check_frequency

_TRUNC_UNIT = {"W": "WEEK", "M": "MM"}


def today(zone: str = "Europe/Copenhagen") -> Column:
    """Today's date in the business time zone."""
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), zone))


def as_date(as_of: dt.date | Column | None, zone: str = "Europe/Copenhagen") -> Column:
    """The reference date as a column; ``None`` means today."""
    if as_of is None:
        return today(zone)
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def months_before(day: Column, months: int) -> Column:
    """The day ``months`` earlier, clamped to the end of the month."""
    return F.add_months(day, -months)


def period_start(day: Column, frequency: str) -> Column:
    """First day of the day's period: itself, its Monday, or the first of its month."""
    tag = check_frequency(frequency)
    return day if tag == "D" else F.to_date(F.date_trunc(_TRUNC_UNIT[tag], day))


def embedded_date(text: Column) -> Column:
    """First yyyy-mm-dd inside a text; NULL when absent or not a calendar date."""
    found = F.regexp_extract(text, r"\d{4}-\d{2}-\d{2}", 0)
    return F.try_to_date(F.nullif(found, F.lit("")), "yyyy-MM-dd")
