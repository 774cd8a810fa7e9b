"""Durations and encoded dates.

Second counts are built from the date and clock fields, so a timestamp without
time zone gives the same answer under any session time zone.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def second_number(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 on the clock of the timestamp."""
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end; NULL when an end is missing."""
    return second_number(end) - second_number(start)


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def hhmmss_to_seconds(encoded: Column) -> Column:
    """Seconds of a duration stored as an HHMMSS number."""
    value = encoded.cast("bigint")
    hours, minutes = F.floor(value / 10000), F.floor(value / 100) % 100
    return hours * 3600 + minutes * 60 + value % 100


def run_datetime_text(run_date: Column, run_time: Column) -> Column:
    """``yyyymmdd HH:MM:SS`` from a yyyymmdd number and an HHMMSS number."""
    digits = F.right(F.concat(F.lit("000000"), run_time.cast("string")), F.lit(6))
    colon = F.lit(":")
    return F.concat(
        run_date.cast("string"),
        F.lit(" "),
        F.substring(digits, 1, 2),
        colon,
        F.substring(digits, 3, 2),
        colon,
        F.substring(digits, 5, 2),
    )


def as_date(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def as_timestamp(value: datetime | str, like: str = "timestamp_ntz") -> Column:
    return F.lit(str(value)).cast(like)
