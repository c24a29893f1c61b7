"""Deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = ["surrogate_key", "time_text", "stream_key"]

# Fixed value: text that stands for NULL inside a surrogate key.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def time_text(c: Column) -> Column:
    """Pinned text form of a time, so that batch and stream build the same keys."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the parts; pass times through `time_text`."""
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_PART)) for p in parts]))


def stream_key(*parts: Column) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])
