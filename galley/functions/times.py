"""Timestamps of the provider feed: ISO-8601 text and zone-less UTC time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_literal(when: dt.datetime) -> Column:
    """A zone-less literal; a plain datetime literal would depend on the local zone."""
    return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_utc(text: Column) -> Column:
    """ISO-8601 text, with or without an offset, as zone-less UTC; NULL when malformed.

    Text without an offset is read as UTC whatever the session zone is.
    """
    has_zone = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    local = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz")
    )
    return F.when(has_zone, local).otherwise(text.try_cast("timestamp_ntz"))


def iso_utc(when: Column) -> Column:
    """Zone-less UTC time as ISO-8601 text to the second."""
    return F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from ``start`` to ``end``."""
    return F.timestamp_diff("MINUTE", start, end)
