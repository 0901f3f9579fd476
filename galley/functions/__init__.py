"""Column expressions shared by the plans. All are built-in expressions: no Python UDFs."""

from galley.functions.calendar import (
    day_name,
    day_of_week,
    hour_of,
    iso_week,
    is_weekend,
    month_of,
    year_of,
)
from galley.functions.numbers import MONEY, exact_ratio, money, whole
from galley.functions.text import (
    blank_to_null,
    fingerprint,
    join_all,
    join_any,
    json_field,
    remap,
)
from galley.functions.times import iso_utc, minutes_between, parse_utc, utc_literal

__all__ = [
    "MONEY",
    "blank_to_null",
    "day_name",
    "day_of_week",
    "exact_ratio",
    "fingerprint",
    "hour_of",
    "is_weekend",
    "iso_utc",
    "iso_week",
    "join_all",
    "join_any",
    "json_field",
    "minutes_between",
    "money",
    "month_of",
    "parse_utc",
    "remap",
    "utc_literal",
    "whole",
    "year_of",
]
