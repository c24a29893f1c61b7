"""Aggregates that need care: exact quantiles and distinct counts at scale, correlation without zero-variance errors, lists."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pitwall.operators.ordered import split_running_total
from pitwall.operators.rows import null_safe_join

#: Parts of a stretch of values that a round of `values_at` counts.
CELLS = 1024
#: Bits of a word of `distinct_counts`.
WORD = 64


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL for zero variance or a single row."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0)))


def min_by_first(value: Column, key: Column) -> Column:
    """Value at the smallest key; the smallest value wins a tie."""
    return F.min_by(value, F.when(key.isNotNull(), F.struct(key, value)))


def _cell(v: Column, low: Column, high: Column) -> Column:
    """Which of CELLS equal stretches of a finite range a value lies in; never falling with the value. What isn't finite lies in cells beyond, NaN last."""
    v, low, high = v.cast("double"), low.cast("double"), high.cast("double")
    place = F.when(high > low, F.least(F.floor((v / 2 - low / 2) / (high / 2 - low / 2) * CELLS), F.lit(CELLS - 1))).otherwise(F.lit(0))
    return F.when(F.isnan(v), CELLS + 1).when(v == float("inf"), CELLS).when(v == float("-inf"), -1).otherwise(place).cast("int")


def _finite(v: Column) -> Column:
    d = v.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), v)


def _at_rank(sorted_entries: Column, rank: Column) -> Column:
    """The entry of (…, n) structs in order that holds the place `rank`, counted from 0, and the rows before it, as a struct (before, entry)."""

    def step(seen: Column, entry: Column) -> Column:
        here = seen["entry"].isNull() & (seen["before"] + entry["n"] > rank)
        return F.struct(F.when(seen["entry"].isNotNull() | here, seen["before"]).otherwise(seen["before"] + entry["n"]).alias("before"), F.when(here, entry).otherwise(seen["entry"]).alias("entry"))

    nothing = F.when(F.lit(False), F.get(sorted_entries, 0))
    return F.aggregate(sorted_entries, F.struct(F.lit(0).cast("bigint").alias("before"), nothing.alias("entry")), step)


def values_at(df: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, Callable[[Column], Column]], rounds: int = 2) -> DataFrame:
    """Per group the values at given places of its order, all in one go: the keys and a column per entry of `ranks`, which tells a place, counted from 0, from the
    number of the group's values.  NULL values don't count; NaN comes last.

    Values are counted first (combined on the map side).  Then a round takes, for each group and place, the stretch of values it must lie in, counts CELLS equal
    parts of it, and goes on with the one that holds the place; `rounds` rounds narrow it to a CELLS^rounds-th, from which the value is picked out by its
    counts.  What a task puts in order is cells, and in the end the different values of one last cell; no group is ever ordered.  All rounds read the same
    counts, whose exchange they share.  The result is exact for any number of rounds.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    v = F.col(value)
    bounds = counted.groupBy(*keys).agg(F.min(_finite(v)).alias("_low"), F.max(_finite(v)).alias("_high"), F.sum("_n").alias("_total"))
    places = F.array(*[F.struct(F.lit(name).alias("q"), rank(F.col("_total")).cast("bigint").alias("r")) for name, rank in ranks.items()])
    state = bounds.select(*keys, F.explode(places).alias("_p"), "_low", "_high").select(*keys, F.col("_p.q").alias("_q"), F.col("_p.r").alias("_r"), "_low", "_high", F.lit(True).alias("_all"))
    for _ in range(rounds):
        rows = null_safe_join(counted, state, keys, "inner").filter(F.col("_all") | v.between(F.col("_low"), F.col("_high")))
        cells = rows.groupBy(*keys, "_q", _cell(v, F.col("_low"), F.col("_high")).alias("_c")).agg(
            F.sum("_n").alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.min("_r").alias("_r"))
        order = F.array_sort(F.collect_list(F.struct("_c", "n", "low", "high")))
        found = cells.groupBy(*keys, "_q").agg(F.min("_r").alias("_r"), order.alias("_cells")).withColumn("_at", _at_rank(F.col("_cells"), F.col("_r")))
        state = found.select(*keys, "_q", (F.col("_r") - F.col("_at.before")).alias("_r"), F.col("_at.entry.low").alias("_low"), F.col("_at.entry.high").alias("_high"), F.lit(False).alias("_all"))
    rows = null_safe_join(counted, state, keys, "inner").filter(v.between(F.col("_low"), F.col("_high")))
    last = rows.groupBy(*keys, "_q").agg(F.min("_r").alias("_r"), F.array_sort(F.collect_list(F.struct(v.alias("v"), F.col("_n").alias("n")))).alias("_vs"))
    picked = last.withColumn("_v", _at_rank(F.col("_vs"), F.col("_r"))["entry"]["v"])
    return picked.groupBy(*keys).agg(*[F.max(F.when(F.col("_q") == name, F.col("_v"))).alias(name) for name in ranks])


def _octave_cell(v: Column) -> Column:
    """A cell of a 4,096th of an octave, never falling with the value; negative values mirrored, zero between, NaN last."""
    size = F.floor(F.log2(F.abs(v.cast("double"))) * 4096) + (1 << 23)
    cell = F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0))
    return F.when(F.isnan(v.cast("double")), 1 << 40).otherwise(cell).cast("bigint")


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str, cell: Callable[[Column], Column] = _octave_cell) -> DataFrame:
    """Exact median per group in one pass over the rows, without a group's values in one task.

    Values are counted (combined on the map side) and cut into cells along their order; a cell's counts are summed up in place, and cells hand the sum of those
    before them on by their first row (`split_running_total`), so what a task puts in order is a cell's different values.  Then each value knows the places it
    fills, and the two in the middle are picked.  Groups whose values lie within a thousandth of each other ask for a narrower `cell`, or for `values_at`.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    placed = split_running_total(counted, keys, [F.col(value)], cell(F.col(value)), "_n", "_before", "_total")

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n")), F.col(value)))

    picks = [at_rank(r) for r in (F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2))]
    return placed.groupBy(*keys).agg(((picks[0] + picks[1]) / 2).alias(out))


def with_places(df: DataFrame, keys: Sequence[str], value: str, cell: Callable[[Column], Column] = _octave_cell) -> DataFrame:
    """The rows with their place in their group's order of a value, from 0 on, and the group's size, for `median_of_places` in an aggregate of the same groups.

    For rows that are dear to compute: they are computed once, where a median joined to an aggregate computes them twice.  A task puts the rows of a cell in
    order, so many rows of one value belong to `exact_median`, which counts them first.  The value must not be NULL.
    """
    return split_running_total(df.withColumn("_one", F.lit(1)), keys, [F.col(value)], cell(F.col(value)), "_one", "_place", "_size").drop("_one")


def median_of_places(value: str) -> Column:
    """The median of rows that know their place, as an aggregate."""
    middle = [F.max(F.when(F.col("_place") == F.floor(at), F.col(value))) for at in ((F.col("_size") - 1) / 2, F.col("_size") / 2)]
    return (middle[0] + middle[1]) / 2


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Mapping[str, float]) -> DataFrame:
    """Exact quantiles per group, several at once, interpolated between neighbouring values as `percentile` does."""
    ranks = {}
    for name, share in shares.items():
        ranks[f"_l_{name}"] = lambda n, s=share: F.floor((n - 1) * F.lit(s))
        ranks[f"_h_{name}"] = lambda n, s=share: F.ceil((n - 1) * F.lit(s))
    total = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.count("*").alias("_total"))
    found = null_safe_join(values_at(df, keys, value, ranks), total, keys)

    def between(name: str, share: float) -> Column:
        low, high, at = F.col(f"_l_{name}").cast("double"), F.col(f"_h_{name}").cast("double"), (F.col("_total") - 1) * F.lit(share)
        part = at - F.floor(at)
        return F.when(low == high, low).otherwise(low * (1 - part) + high * part)

    return found.select(*keys, *[between(n, s).alias(n) for n, s in shares.items()])


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Per group the number of different values of several whole-number columns, exact and in one pass: the keys and a column per entry of `columns`.

    Values set bits in words of 64, a long each, which are combined on the map side, merged, and counted. Each column has words of its own, so what a task holds
    is the words its rows touch in one column after the other, never a combination of several columns' words; a scattered value costs one word. NULL doesn't count.
    """
    values = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("bigint").alias("v")) for n, c in columns.items()])
    each = df.select(*keys, F.explode(values).alias("_e")).select(*keys, F.col("_e.name").alias("_name"), F.col("_e.v").alias("_v"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_v").bitwiseAND(F.lit(WORD - 1)).cast("int"))
    words = each.groupBy(*keys, "_name", F.shiftright("_v", WORD.bit_length() - 1).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    ones = F.bit_count("_bits")
    return words.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(F.col("_name") == n, ones)), F.lit(0)).alias(n) for n in columns])


def with_median(grouped: DataFrame, df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Adds the exact median to an aggregate of the same groups; NULL keys form a group as usual."""
    return null_safe_join(grouped, exact_median(df, keys, value, out), keys)


def ordered_list_text(df: DataFrame, keys: Sequence[str], value: str, out: str, sep: str = ", ", distinct: bool = False) -> DataFrame:
    """Values of a group in order as one text.

    Repeats are counted first, so what is collected per group is one entry per distinct value.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    entries = F.sort_array(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_n").cast("int").alias("n"))))
    texts = F.transform(
        entries, lambda e: e["v"].cast("string") if distinct else F.array_join(F.array_repeat(e["v"].cast("string"), e["n"]), sep)
    )
    return counted.groupBy(*keys).agg(F.array_join(texts, sep).alias(out))



def ordered_entries(df: DataFrame, keys: Sequence[str], value: str, place: str, n: str) -> DataFrame:
    """The long form of an ordered list: one row per group and different value, with its place among them, from 1 on, and how often it occurs.

    No group is gathered: values are counted on the map side, and places are summed up over cells (`split_running_total`).
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias(n)).withColumn("_one", F.lit(1))
    # texts fall into cells by their first two characters; both go by code points
    text = F.ascii(F.substring(F.col(value), 1, 1)).cast("bigint") * (1 << 21) + F.ascii(F.substring(F.col(value), 2, 1))
    cell = text if isinstance(df.schema[value].dataType, T.StringType) else _octave_cell(F.col(value))
    placed = split_running_total(counted, keys, [F.col(value)], cell, "_one", "_before", "_of")
    return placed.select(*keys, value, (F.col("_before") + 1).alias(place), n)
