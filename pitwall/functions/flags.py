"""Flags, buckets and lookups of the racing domain."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pitwall.settings import DRS_ACTIVE, DRS_DETECTED, POINTS

__all__ = [
    "bool_int", "within", "drs_active", "drs_detected", "points_for", "track_band", "humidity_band", "sky_band",
    "stint_length", "guarded_stint_length", "tyre_age", "pct_delta", "null_or_non_negative", "or_zero",
]


def bool_int(c: Column) -> Column:
    """1 for true, 0 for false and NULL."""
    return F.coalesce(c.cast("int"), F.lit(0))


def within(c: Column, bounds: tuple[float, float]) -> Column:
    """Closed range test that is false for NULL."""
    return F.coalesce(c.between(*bounds), F.lit(False))


def drs_active(c: Column) -> Column:
    return bool_int(c.isin(*DRS_ACTIVE))


def drs_detected(c: Column) -> Column:
    return bool_int(c.isin(*DRS_DETECTED))


def points_for(position: Column) -> Column:
    expr = None
    for place, score in POINTS.items():
        expr = F.when(position == place, score) if expr is None else expr.when(position == place, score)
    return expr.otherwise(0)


def track_band(c: Column) -> Column:
    return (
        F.when(c < 25, "TRACK_COLD").when(c < 35, "TRACK_MODERATE").when(c < 45, "TRACK_HOT")
        .when(c >= 45, "TRACK_VERY_HOT").otherwise("UNKNOWN")
    )


def humidity_band(c: Column) -> Column:
    return (
        F.when(c < 40, "HUMIDITY_LOW").when(c < 70, "HUMIDITY_MEDIUM").when(c >= 70, "HUMIDITY_HIGH")
        .otherwise("UNKNOWN")
    )


def sky_band(rain: Column, humidity: Column) -> Column:
    return (
        F.when(rain, "RAIN").when(humidity >= 80, "HUMID").when(humidity >= 60, "MODERATE_HUMIDITY").otherwise("DRY")
    )


def stint_length(start: Column, end: Column) -> Column:
    """In long integers, so that wrong bounds cannot overflow."""
    return end.cast("bigint") - start + 1


def guarded_stint_length(start: Column, end: Column) -> Column:
    return F.when(end >= start, stint_length(start, end))


def tyre_age(lap: Column, stint_start: Column, age_at_start: Column) -> Column:
    """Age carried into the stint plus laps run in it; laps run in it alone when the age is unknown."""
    run = lap.cast("bigint") - stint_start
    return F.coalesce(age_at_start + run, run + 1)


def pct_delta(value: Column, base: Column) -> Column:
    return F.try_divide(value - base, base)


def null_or_non_negative(c: Column) -> Column:
    return c.isNull() | (c >= 0)


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))
