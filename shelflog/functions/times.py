"""Times. Every stored time is a UTC wall clock (``timestamp_ntz``); the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _crossed(unit: str, earlier: Column, later: Column) -> Column:
    # Counts unit boundaries, not whole units: 00:59 to 01:01 is one hour apart.
    return F.timestamp_diff(unit, F.date_trunc(unit, earlier), F.date_trunc(unit, later))


def hours_between(earlier: Column, later: Column) -> Column:
    return _crossed("HOUR", earlier, later)


def seconds_between(earlier: Column, later: Column) -> Column:
    return _crossed("SECOND", earlier, later)


def day_of(moment: Column) -> Column:
    return moment.cast("date")


def read_utc(text: Column) -> Column:
    """ISO-8601 text to a UTC wall clock; null if unreadable.

    Going through ``timestamp`` applies an offset. A direct cast to ``timestamp_ntz``
    would drop it. Text without an offset counts as UTC.
    """
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def utc_text(moment: Column) -> Column:
    """Fixed-width wall-clock text with six fraction digits."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def iso_utc(moment: Column) -> Column:
    """ISO-8601 with offset; the fraction is printed only when it is not zero."""
    fraction = F.date_format(moment, "SSSSSS")
    return F.concat(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
        F.lit("+00:00"),
    )
