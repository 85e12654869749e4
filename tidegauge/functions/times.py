"""Time and number helpers as Spark columns (FN-3 … FN-9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to timestamp; null for anything else (FN-3, FN-8, PRJ-2).

    The plain cast would end the query at the first bad string under ANSI mode.
    Text without an offset is read in the session zone, which is UTC.
    """
    return F.try_to_timestamp(text)


def iso(ts: Column, offset: bool = False) -> Column:
    """ISO-8601 text, the fraction only where there is one (FN-4)."""
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(full.endswith(".000000"), F.left(full, F.lit(19))).otherwise(full)
    return F.concat(text, F.lit("+00:00")) if offset else text


def clock(ts: Column) -> Column:
    """Time-of-day label (FN-5)."""
    return F.date_format(ts, "HH:mm:ss")


def round_half_even(number: Column, digits: int = 1) -> Column:
    """Rounding for display, ties to the even digit (FN-6)."""
    return F.bround(number, digits)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for both timestamp types."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(earlier: Column, later: Column) -> Column:
    """Elapsed seconds with their fraction (FN-9)."""
    return (micros(later) - micros(earlier)) / F.lit(1_000_000.0)


def as_type(us: Column, like: DataFrame, name: str) -> Column:
    """Microseconds back to the timestamp type that ``like[name]`` has."""
    return F.timestamp_micros(us).cast(like.schema[name].dataType)
