"""Timestamps are kept as UTC wall-clock values (``timestamp_ntz``), whatever the session zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_NAIVE = r"^\s*\d{4}-\d{2}-\d{2}([ T][\d:.]*)?\s*$"
ISO_ANY = r"^\s*\d{4}-\d{2}-\d{2}[ T]"


def as_wall_clock(moment: str | date | datetime) -> Column:
    """A literal moment such as the report's reference time."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def parse_wall_clock(text: Column, extra_formats: tuple[str, ...] = ()) -> Column:
    """ISO text to a UTC wall-clock timestamp; anything else becomes NULL.

    Text with a zone or an offset is moved to UTC first. `extra_formats` are Spark datetime
    patterns that are tried, in order, on text that is not ISO.
    """
    moved = F.convert_timezone(
        None, F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz")
    )
    iso = F.when(text.rlike(ISO_NAIVE), text.try_cast("timestamp_ntz")).when(
        text.rlike(ISO_ANY), moved
    )
    others = [
        F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz") for pattern in extra_formats
    ]
    return F.coalesce(iso, *others) if others else iso


def iso_week(moment: Column) -> Column:
    """The Monday that starts the ISO week; one date per ISO year and week."""
    return F.trunc(moment, "week")


def iso_week_key(moment: Column) -> Column:
    """ISO year and unpadded ISO week as text, e.g. ``2024-W5``."""
    return F.concat(
        F.date_part(F.lit("YEAROFWEEK"), moment).cast("string"),
        F.lit("-W"),
        F.weekofyear(moment).cast("string"),
    )


def month_of(moment: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(moment, "month")


def months_before(moment: Column, months: int) -> Column:
    """The same clock time `months` earlier, clamped to the end of a shorter month."""
    return (moment - F.make_ym_interval(F.lit(0), F.lit(months))).cast("timestamp_ntz")


def days_between(earlier: Column, later: Column) -> Column:
    """Elapsed days with fraction."""
    return F.timestamp_diff("MICROSECOND", earlier, later).cast("double") / F.lit(86_400_000_000.0)
