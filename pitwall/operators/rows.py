"""Row selection per key and joins on nullable keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RN = "_rn"


def qualify_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key in the given order.

    A `row_number() = 1` filter is planned with a group limit below the exchange, so each map task ships
    at most one row per key and a hot key costs no more than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def qualify(df: DataFrame, window_value: Column, predicate) -> DataFrame:
    """Filter on a window result without keeping it: `predicate` gets the window value as a column."""
    return df.withColumn("_q", window_value).filter(predicate(F.col("_q"))).drop("_q")


def latest(df: DataFrame, keys: Sequence[str], at: str, ties: Sequence[Column] = ()) -> DataFrame:
    return qualify_first(df, keys, [F.col(at).desc_nulls_last(), *ties])


def earliest(df: DataFrame, keys: Sequence[str], at: str, ties: Sequence[Column] = ()) -> DataFrame:
    return qualify_first(df, keys, [F.col(at).asc_nulls_last(), *ties])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL equals NULL; the keys appear once, from the left."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        part = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = part if cond is None else cond & part
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def with_group_values(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Whole-group aggregates on every row.

    Written as partial aggregate plus join instead of an unframed window: the aggregate is combined on the
    map side, and a hot key in the join is split by AQE, where a window would pull the group into one task.
    Rows with a NULL key form a group, as in a window.
    """
    return null_safe_join(df, df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()]), keys)
