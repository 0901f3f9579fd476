"""Calendar parts of a date or timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_of(when: Column) -> Column:
    return F.year(when)


def month_of(when: Column) -> Column:
    return F.month(when)


def hour_of(when: Column) -> Column:
    return F.hour(when)


def iso_week(when: Column) -> Column:
    return F.weekofyear(when)


def day_of_week(when: Column) -> Column:
    """0 = Sunday ... 6 = Saturday (Spark itself counts Sunday as 1)."""
    return F.dayofweek(when) - F.lit(1)


def day_name(when: Column) -> Column:
    """Full English day name."""
    return F.date_format(when, "EEEE")


def is_weekend(when: Column) -> Column:
    return F.dayofweek(when).isin(1, 7)
