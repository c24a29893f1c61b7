"""Unions and wide-to-long."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def append_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def sectors_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], number: str, value: str) -> DataFrame:
    """One row per id row and column, NULL values kept; a single scan instead of a union of scans."""
    entries = F.array(*[F.struct(F.lit(i).alias("n"), F.col(c).alias("v")) for i, c in enumerate(columns, 1)])
    return df.select(*ids, F.explode(entries).alias("_e")).select(*ids, F.col("_e.n").alias(number), F.col("_e.v").alias(value))


def merge_feeds(feeds: dict[str, DataFrame], at: str) -> DataFrame:
    """Time-ordered merge of feeds; at equal times the order of the mapping decides."""
    tagged = [d.withColumn("feed", F.lit(name)).withColumn("feed_rank", F.lit(i)) for i, (name, d) in enumerate(feeds.items())]
    return append_all(tagged).orderBy(at, "feed_rank")
