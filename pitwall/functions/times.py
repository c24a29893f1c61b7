"""Zone-less UTC time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = [
    "trunc_to", "add_seconds", "add_millis", "seconds_between", "millis_between", "micros", "from_micros",
    "utc", "utc_or_epoch", "slice_start",
]


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def from_micros(c: Column) -> Column:
    return F.timestamp_micros(c).cast("timestamp_ntz")


def trunc_to(unit: str, c: Column) -> Column:
    """date_trunc that keeps the zone-less type."""
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def slice_start(c: Column, minutes: int) -> Column:
    """Start of the aligned slice of so many minutes."""
    width = minutes * 60_000_000
    return from_micros(F.floor(micros(c) / F.lit(width)).cast("bigint") * F.lit(width))


def add_seconds(ts: Column, seconds: Column) -> Column:
    """Adds seconds rounded to whole ones."""
    return F.timestamp_add("SECOND", F.round(seconds).cast("int"), ts)


def add_millis(ts: Column, millis: Column) -> Column:
    return F.timestamp_add("MILLISECOND", F.round(millis).cast("int"), ts)


def seconds_between(a: Column, b: Column) -> Column:
    """Second boundaries crossed from a to b."""
    return F.unix_seconds(b.cast("timestamp")) - F.unix_seconds(a.cast("timestamp"))


def millis_between(a: Column, b: Column) -> Column:
    """Millisecond boundaries crossed from a to b."""
    return F.unix_millis(b.cast("timestamp")) - F.unix_millis(a.cast("timestamp"))


def utc(c: Column) -> Column:
    """ISO text, with or without an offset, as UTC wall clock; unreadable text is NULL."""
    return c.cast("string").try_cast("timestamp").cast("timestamp_ntz")


def utc_or_epoch(c: Column) -> Column:
    """As `utc`, cut to milliseconds, with the epoch for unreadable text."""
    parsed = F.coalesce(c.cast("string").try_cast("timestamp"), F.timestamp_micros(F.lit(0).cast("bigint")))
    return F.date_trunc("millisecond", parsed).cast("timestamp_ntz")
