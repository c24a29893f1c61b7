"""Joins of events with intervals: range, last-in-interval, nearest, as-of; aggregates over spans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pitwall.functions.times import micros
from pitwall.operators.dyadic import cover, highest_level, nodes_of
from pitwall.operators.ordered import neighbours, time_bucket

BIN = "_bin"
WIDTH = "_width"
LEVELS = "_levels"
MINUTE_US = 60_000_000
#: Points that a task of `span_aggregates` spreads over the levels.
PART_POINTS = 50_000


def spacing(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Per key the mean distance of consecutive events in microseconds, one minute at least: the keys and WIDTH.

    Intervals that run from one event of a key to its next have this mean length, so cutting the key's time into cells of this width gives about
    three cells per interval at most in total, however unequal the intervals are, and a cell of a busy key is as narrow as its own events ask for.
    """
    spans = df.dropna(subset=[*keys, at]).groupBy(*keys).agg((F.max(micros(F.col(at))) - F.min(micros(F.col(at)))).alias("_span"), F.count(at).alias("_n"))
    mean = F.greatest(F.col("_span") / F.col("_n"), F.lit(float(MINUTE_US)))
    return spans.select(*keys, mean.cast("bigint").alias(WIDTH))


def _levels(spans: DataFrame, keys: Sequence[str], start: str, end: str, width: DataFrame | int) -> DataFrame:
    """Per key the cell width, and in LEVELS the levels of nodes that its spans may use: up to the power of eight that its longest span has cells."""
    longest = spans.groupBy(*keys).agg(F.max(micros(F.col(end)) - micros(F.col(start))).alias("_long"))
    wide = longest.withColumn(WIDTH, F.lit(width)) if isinstance(width, int) else longest.join(width, list(keys))
    return wide.select(*keys, WIDTH, F.sequence(F.lit(0), highest_level(F.floor(F.col("_long") / F.col(WIDTH)) + 2)).alias(LEVELS))


def range_join(
    intervals: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    at: str,
    width: DataFrame | int,
    closed: bool = False,
    keep_bin: bool = False,
) -> DataFrame:
    """All pairs with `start <= at < end` (or `<= end` when closed) and equal keys.

    Time is cut into cells of a number of microseconds (`width`), or of one per key (`spacing`), carried on both sides by a join with one row per key; keys
    without a width have no pairs.  An interval is cut into the nodes of a tree over its cells (`dyadic`): one of ordinary length stays in the cells it
    touches, a long one becomes few large nodes, however far off its end is.  A point goes to its node of each level that intervals of its key may use,
    mostly one.  A hot key is so spread over its nodes, a task only sees events near its intervals, and no pair appears twice.  `keep_bin` leaves the node in the
    result: grouping by keys, bin and more then reuses the partitioning of the join.
    """

    def cut(c: str) -> Column:
        return F.floor(micros(F.col(c)) / F.col(WIDTH)).cast("bigint")

    def wide(df: DataFrame) -> DataFrame:
        return df.withColumn(WIDTH, F.lit(width)) if isinstance(width, int) else df.join(width, list(keys))

    spread = wide(intervals.filter(F.col(start) <= F.col(end))).withColumn(BIN, F.explode(cover(cut(start), cut(end)))).drop(WIDTH)
    located = points.join(_levels(intervals, keys, start, end, width), list(keys)).withColumn(BIN, F.explode(nodes_of(cut(at), F.col(LEVELS)))).drop(WIDTH, LEVELS)
    pairs = spread.join(located, [*keys, BIN], "inner")
    upper = F.col(at) <= F.col(end) if closed else F.col(at) < F.col(end)
    pairs = pairs.filter((F.col(at) >= F.col(start)) & upper)
    return pairs if keep_bin else pairs.drop(BIN)


def range_left_join(intervals: DataFrame, points: DataFrame, keys: Sequence[str], start: str, end: str, at: str) -> DataFrame:
    """Every interval with each point of its key with `start <= at <= end`, and with NULLs where it has none: the interval's columns, then the points' others.

    The pairs leave the range join as they are found and are never dealt out again, so what is shuffled grows with the two sides, however many pairs there are.
    An interval has a point just when the last one up to its end lies at or after its start, which an as-of join finds for each, repeated ones too.
    """
    rest = [c for c in points.columns if c not in keys]
    pairs = range_join(intervals, points, keys, start, end, at, spacing(points, keys, at), closed=True).select(*intervals.columns, *rest)
    last = points.select(*keys, F.col(at).alias("_last_at"), F.lit(True).alias("_any"))
    alone = asof_join(intervals, last, keys, end, "_last_at", ["_any"]).filter(~F.coalesce(F.col("_last_at") >= F.col(start), F.lit(False)))
    return pairs.union(alone.select(*intervals.columns, *[F.lit(None).cast(points.schema[c].dataType).alias(c) for c in rest]))


def span_aggregates(
    spans: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    at: str,
    values: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Per span the aggregates of its key's points with `start <= at <= end`: the span's columns and one per entry of `values`, a name with a kind (sum, min,
    max or count) and a column of the points.  Spans without points keep NULL, counts 0; equal spans are one row.

    Points are aggregated to the nodes of a tree over time in microseconds, once per level that spans of the key may use; a span's nodes are exactly its time, so
    it adds up some dozens of rows whatever it holds, meets no point itself, and nothing is subtracted: a NaN or an infinite value changes the spans that hold it
    and no other.  Points are counted first, as a task takes PART_POINTS of them on average, however many there are.
    """
    first = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
    again = {"sum": F.sum, "min": F.min, "max": F.max, "count": lambda c: F.coalesce(F.sum(c), F.lit(0))}
    ids = spans.columns
    cut = spans.withColumn(BIN, F.explode_outer(cover(micros(F.col(start)), micros(F.col(end)))))
    levels = _levels(spans, keys, start, end, 1)
    given = points.select(*keys, at, *[c.alias(f"_v_{n}") for n, (_, c) in values.items()]).filter(F.col(at).isNotNull())
    # a point is a row in each of a dozen levels: parts are as many as the points ask for, and a part is whole minutes, so that most nodes are met in one
    parts = 1 + given.count() // PART_POINTS
    # dealt out after the join with the levels, which may gather a key
    dealt = given.join(levels, list(keys)).repartition(parts, *keys, F.floor(micros(F.col(at)) / MINUTE_US))
    nodes = dealt.withColumn(BIN, F.explode(nodes_of(micros(F.col(at)), F.col(LEVELS)))).groupBy(*keys, BIN).agg(
        *[first[kind](f"_v_{n}").alias(f"_v_{n}") for n, (kind, _) in values.items()])
    return cut.join(nodes, [*keys, BIN], "left").groupBy(*ids).agg(*[again[kind](f"_v_{n}").alias(n) for n, (kind, _) in values.items()])


def explode_numbers(
    spans: DataFrame, keys: Sequence[str], start: str, end: str, numbered: DataFrame, number: str, outer: bool = False
) -> DataFrame:
    """One row per whole number of each closed range; `outer` keeps a span without any, with NULL.

    A range is cut to the numbers its own key has (one row per key, aggregated from `numbered`), so a wrong bound, even together with a wrong number of
    another key, cannot blow up a row.
    """
    seen = numbered.dropna(subset=[*keys, number]).groupBy(*keys).agg(F.min(number).alias("_low"), F.max(number).alias("_high"))
    low, high = F.greatest(F.col(start), F.col("_low")), F.least(F.col(end), F.col("_high"))
    given = F.col(start).isNotNull() & F.col(end).isNotNull() & F.col("_low").isNotNull()
    numbers = F.when(given & (low <= high), F.sequence(low, high))
    cut = spans.join(seen, list(keys), "left")
    return cut.select(*spans.columns, (F.explode_outer if outer else F.explode)(numbers).alias(number))


def last_in_interval(
    intervals: DataFrame,
    feeds: Mapping[str, DataFrame],
    keys: Sequence[str],
    id_cols: Sequence[str],
    start: str,
    end: str,
    width: DataFrame | int,
) -> DataFrame:
    """Latest row of each feed inside every interval that has one, for several feeds in a single join.

    A feed is a DataFrame of the keys, its time column, and its values, in that order; the result holds time and
    values of all feeds.  The latest row is a maximum over (time, values), which is combined on the map side and
    needs no duplicate removal before.
    """
    at, packed, layout = "_at", [], {}
    for name, df in feeds.items():
        fields = [c for c in df.columns if c not in keys]
        layout[name] = fields
        packed.append(df.select(*keys, F.col(fields[0]).alias(at), F.struct(*fields).alias(f"_f_{name}")))
    points = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), packed)
    narrow = intervals.select(*dict.fromkeys([*keys, *id_cols, start, end]))
    pairs = range_join(narrow, points, keys, start, end, at, width)
    best = pairs.groupBy(*id_cols).agg(*[F.max(f"_f_{name}").alias(f"_f_{name}") for name in feeds])
    return best.select(*id_cols, *[F.col(f"_f_{name}")[c].alias(c) for name, fields in layout.items() for c in fields])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_at: str,
    right_at: str,
    values: Sequence[str],
) -> DataFrame:
    """Every left row with the latest right row at or before it; NULLs where there is none.

    A right row is valid from its time to that of the next one of its key, found by one pass over the right side; of rows at one time the largest
    counts.  Time is cut into cells as wide as the key's readings are apart, and a reading is kept in the nodes of a tree over the cells that its validity
    is made of (`dyadic`), so a reading that long stays the last one is in few nodes.  Left rows meet them by key and node, in a plain join that is split at
    run time where a node holds very many left rows.  Left rows before a key's first reading have none, those at or after its last one take it from one row
    per key; both are dealt out by a hash.  Left rows are neither sorted nor gathered by key.
    """
    stamped = right.filter(F.col(right_at).isNotNull()).groupBy(*keys, right_at).agg(F.max(F.struct(*values)).alias("_v"))
    reading = F.struct(F.col(right_at), *[F.col("_v")[v].alias(v) for v in values])
    linked = neighbours(stamped, keys, [right_at], time_bucket(F.col(right_at)), next={"_until": F.col(right_at)}).withColumn("_reading", reading)
    span = F.max(micros(F.col(right_at))) - F.min(micros(F.col(right_at)))
    ends = stamped.groupBy(*keys).agg(
        F.max(F.struct(F.col(right_at), F.col("_v"))).alias("_e"), F.min(right_at).alias("_first"), F.greatest(span / F.count("*"), F.lit(float(MINUTE_US))).cast("bigint").alias(WIDTH)
    ).select(*keys, F.struct(F.col("_e")[right_at].alias(right_at), *[F.col("_e._v")[v].alias(v) for v in values]).alias("_last"), "_first", WIDTH)

    def cut(c: Column) -> Column:
        return F.floor(micros(c) / F.col(WIDTH)).cast("bigint")

    last_us = F.timestamp_add("MICROSECOND", F.lit(-1), F.col("_until"))
    held = linked.filter(F.col("_until").isNotNull())
    spread = held.join(ends.select(*keys, WIDTH), list(keys)).select(
        *keys, F.explode(cover(cut(F.col(right_at)), cut(last_us))).alias(BIN), F.col(right_at).alias("_from"), "_until", "_reading")
    tail = ends.join(_levels(held, keys, right_at, "_until", ends.select(*keys, WIDTH)).drop(WIDTH), list(keys), "left").select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_last", "_first", WIDTH, LEVELS)
    spread = spread.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col(BIN).alias("_r_bin"), F.lit(True).alias("_r_open"), "_from", "_until", "_reading")

    rows = left.join(tail, reduce(lambda a, b: a & b, [left[k] == F.col(f"_k_{k}") for k in keys]), "left")
    within = F.coalesce((F.col(left_at) < F.col("_last")[right_at]) & (F.col(left_at) >= F.col("_first")), F.lit(False))
    dealt = F.array(F.pmod(F.xxhash64(*left.columns), F.lit(4096)))
    rows = rows.withColumn("_open", within).withColumn(BIN, F.explode(F.when(within, nodes_of(cut(F.col(left_at)), F.col(LEVELS))).otherwise(dealt)))
    met = reduce(lambda a, b: a & b, [left[k] == F.col(f"_r_{k}") for k in keys]) & (F.col("_open") == F.col("_r_open")) & (F.col(BIN) == F.col("_r_bin"))
    found = rows.join(spread, met & (F.col(left_at) >= F.col("_from")) & (F.col(left_at) < F.col("_until")), "left")
    # a row within the readings is there once for each level, and one of its nodes has the reading
    found = found.filter(~F.col("_open") | F.col("_from").isNotNull())
    hit = F.when(F.col(left_at) >= F.col("_last")[right_at], F.col("_last")).otherwise(F.col("_reading"))
    return found.withColumn("_hit", hit).select(*[left[c] for c in left.columns], *[F.col("_hit")[c].alias(c) for c in [right_at, *values]])
