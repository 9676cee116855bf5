"""Date expressions. "Now" is always an argument, so a rerun gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_key(day: Column | str) -> Column:
    """First day of the month as ``yyyy-MM-01`` text, the key monthly tables are joined on."""
    return F.date_format(F.trunc(as_column(day), "MM"), "yyyy-MM-dd")


def epoch_date(seconds: Column | str) -> Column:
    """UTC calendar date of a Unix time in seconds, whatever the session time zone is."""
    return F.date_from_unix_date(F.floor(as_column(seconds) / F.lit(86400)).cast("int"))


def age_hours(moment: Column | str, now: Column) -> Column:
    """Whole seconds between two timestamps, in hours."""
    return (F.unix_timestamp(now) - F.unix_timestamp(as_column(moment))) / F.lit(3600)
