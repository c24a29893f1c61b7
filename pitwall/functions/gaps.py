"""Gap and interval text: seconds, `+1 LAP`, `m:ss.fff`."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = ["is_lapped_gap", "gap_seconds", "interval_seconds", "numeric_gap"]

# The text forms the timing feed uses (matched against the whole text).
LAPPED = r"^(?:\+[0-9]+\s*LAP)$"
PLAIN_SECONDS = r"^[+-]?[0-9]+(\.[0-9]+)?$"
MINUTES_SECONDS = r"^[+-]?[0-9]+:[0-9]{2}(\.[0-9]+)?$"
EMPTY_TOKENS = ("", "none", "null", "nan")


def is_lapped_gap(c: Column) -> Column:
    return F.coalesce(F.upper(F.trim(c.cast("string"))).rlike(LAPPED), F.lit(False))


def gap_seconds(c: Column) -> Column:
    """Seconds of a plain gap; lapped and unreadable gaps are NULL."""
    return F.when(~is_lapped_gap(c), c.cast("string").try_cast("double"))


def interval_seconds(c: Column) -> Column:
    """Seconds of a plain or `m:ss.fff` gap, anything else NULL.

    The sign belongs to the minutes only, so `-1:30` is -60 + 30.
    """
    text = F.trim(c.cast("string"))
    minutes = F.split_part(text, F.lit(":"), F.lit(1)).try_cast("double")
    seconds = F.split_part(text, F.lit(":"), F.lit(2)).try_cast("double")
    return (
        F.when(F.lower(text).isin(*EMPTY_TOKENS), F.lit(None).cast("double"))
        .when(text.rlike(PLAIN_SECONDS), text.try_cast("double"))
        .when(text.rlike(MINUTES_SECONDS), minutes * 60 + seconds)
    )


def numeric_gap(c: Column) -> Column:
    """Number unless the text mentions laps."""
    return F.when(~c.contains("L"), c.try_cast("double"))
