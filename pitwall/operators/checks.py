"""Data-quality checks: each finds violating rows; many are counted in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pitwall.functions import millis_between
from pitwall.operators.ordered import RANK, neighbours, ranked
from pitwall.settings import DRS_STATES


@dataclass(frozen=True)
class Rule:
    """A row is a violation where `broken` is true; `only` limits the rows looked at."""

    name: str
    broken: Column
    only: Column | None = None
    severity: str = "error"

    @property
    def condition(self) -> Column:
        bad = F.coalesce(self.broken, F.lit(False))
        return bad if self.only is None else bad & F.coalesce(self.only, F.lit(False))


def not_null(c: str, only: Column | None = None, severity: str = "error") -> Rule:
    return Rule(f"not_null_{c}", F.col(c).isNull(), only, severity)


def accepted_values(c: str, values: Sequence, only: Column | None = None, severity: str = "error") -> Rule:
    return Rule(f"accepted_values_{c}", ~F.col(c).isin(*values), only, severity)


def accepted_range(c: str, low=None, high=None, severity: str = "error") -> Rule:
    """Outside either bound is a violation; NULL is not."""
    broken = F.lit(False)
    if low is not None:
        broken = broken | (F.col(c) < low)
    if high is not None:
        broken = broken | (F.col(c) > high)
    return Rule(f"accepted_range_{c}", broken, None, severity)


def non_negative(c: str) -> Rule:
    return Rule(f"non_negative_{c}", F.col(c) < 0)


def not_in_future(c: str, now: Column | None = None, tolerance_hours: int = 0) -> Rule:
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    return Rule(f"not_in_future_{c}", F.col(c) > F.timestamp_add("HOUR", F.lit(tolerance_hours), now))


def drs_state(c: str = "drs") -> Rule:
    return accepted_values(c, DRS_STATES)


# Sensor limits of the session-grain project.
TELEMETRY_LIMITS = {"brake": (0, 100), "throttle": (0, 110), "rpm": (0, 15000), "speed": (0, 410)}
# Both pedals above this for neighbouring readings closer than the gap are a sensor fault.
PEDAL_LIMIT, PEDAL_SPEED, PEDAL_RPM, PEDAL_GAP_MS = 105, 50, 5000, 500


def telemetry_rules() -> list[Rule]:
    return [accepted_range(c, lo, hi) for c, (lo, hi) in TELEMETRY_LIMITS.items()]


def ordered_dates(start: str, end: str) -> Rule:
    return Rule(f"ends_before_start_{end}", F.col(end) < F.col(start))


def pit_durations(max_stop: float = 120.0) -> Rule:
    spans = ["raw_pit_duration_seconds", "lane_duration_seconds", "stop_duration_seconds", "pit_stop_duration_seconds"]
    broken = F.coalesce(F.col("stop_duration_seconds") > max_stop, F.lit(False))
    for c in spans:
        broken = broken | F.coalesce(F.col(c) < 0, F.lit(False))
    return Rule("pit_durations", broken)


def sector_times(columns: Sequence[str]) -> Rule:
    broken = F.lit(False)
    for c in columns:
        broken = broken | F.coalesce(F.col(c) < 0, F.lit(False))
    return Rule("sector_times", broken)


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    return df.filter(rule.condition)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; counted with partial aggregates, NULL keys are left out."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key the parent lacks."""
    held = parent.select(F.col(parent_key).alias("_p")).distinct()
    return child.filter(F.col(key).isNotNull()).join(held, F.col(key) == F.col("_p"), "left_anti")


def pedal_faults(df: DataFrame, at: str, keys: Sequence[str] = ()) -> DataFrame:
    """Readings with both pedals far above range that last for neighbouring readings.

    Without keys the neighbours are taken over all cars, as the source does; pass session and driver for the
    sensible meaning.
    """
    high = df.filter(
        (F.col("brake") > PEDAL_LIMIT) & (F.col("throttle") > PEDAL_LIMIT) & (F.col("speed") > PEDAL_SPEED) & (F.col("rpm") > PEDAL_RPM)
    )
    linked = neighbours(ranked(high, keys, at), keys, [at], F.col(RANK), prev={"_before": F.col(at)}, next={"_after": F.col(at)}).drop(RANK)
    near = (millis_between(F.col("_before"), F.col(at)) < PEDAL_GAP_MS) | (millis_between(F.col(at), F.col("_after")) < PEDAL_GAP_MS)
    return linked.filter(F.coalesce(near, F.lit(False))).drop("_before", "_after")


def summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its severity and violation count, from a single pass over the data."""
    counted = df.agg(*[F.count_if(r.condition).alias(f"n{i}") for i, r in enumerate(rules)])
    entries = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(f"n{i}").alias("violations")) for i, r in enumerate(rules)]
    )
    return counted.select(F.explode(entries).alias("e")).select("e.*", (F.col("e.violations") == 0).alias("passed"))


def store_failures(df: DataFrame, rules: Sequence[Rule], path: str) -> None:
    """Violating rows of all rules in one scan, one folder per rule."""
    names = F.array_compact(F.array(*[F.when(r.condition, F.lit(r.name)) for r in rules]))
    df.withColumn("rule", F.explode(names)).write.mode("overwrite").partitionBy("rule").parquet(path)
