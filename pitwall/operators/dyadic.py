"""Nodes of a tree over whole numbers: a node of level l holds 8^l neighbouring numbers, from a multiple of 8^l on.

A span of numbers is the union of few nodes of several levels (at most fourteen a level), however long it is, and a number lies in one node of each level.
So a span and the numbers inside it meet by equality of nodes, each pair once, without a copy of the span for each unit of its length.

A node is one long: its number at its level times 32, plus the level.  Numbers of up to 58 bits fit, which microseconds to the year 9999 are.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FAN_BITS = 3
LEVELS = 20
_SLOTS = 32
#: A span of fewer numbers than a node of level 1 has stays at level 0, so short spans need no second level.
_SHORT = 1 << FAN_BITS


def _down(x: Column, level: Column) -> Column:
    """x / 8^level, rounded down."""
    return F.call_function("shiftright", x, level * FAN_BITS)


def _run(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def cover(low: Column, high: Column) -> Column:
    """The nodes that make up the whole numbers from `low` to `high`, both included, as an array; empty when `low` is above `high` or either is NULL."""
    low, high = low.cast("bigint"), high.cast("bigint")

    def first(level: Column) -> Column:
        return -_down(-low, level)

    def last(level: Column) -> Column:
        return _down(high + 1, level) - 1

    def at(level: Column) -> Column:
        a, z, up = first(level), last(level), level + 1
        inner_a, inner_z = first(up) * _SHORT, last(up) * _SHORT + _SHORT
        numbers = F.when(inner_a < inner_z, F.concat(_run(a, inner_a - 1), _run(inner_z, z))).otherwise(_run(a, z))
        return F.transform(numbers, lambda n: n * _SLOTS + level)

    levels = F.filter(F.sequence(F.lit(0), highest_level(high - low + 1)), lambda l: first(l) <= last(l))
    short = F.transform(F.sequence(low, high), lambda n: n * _SLOTS)
    return F.when(low > high, F.array().cast("array<bigint>")).when(high - low < _SHORT, short).when(
        low.isNotNull() & high.isNotNull(), F.flatten(F.transform(levels, at))).otherwise(F.array().cast("array<bigint>"))


def highest_level(size: Column) -> Column:
    """The highest level that the cover of a span of so many numbers, or of fewer, can use."""
    # a power of eight may come out as a hair less than its exponent
    exponent = F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) / FAN_BITS + 1e-6).cast("int")
    return F.when(size <= _SHORT, 0).otherwise(F.least(exponent, F.lit(LEVELS - 1)))


def level_of(node: Column) -> Column:
    return F.pmod(node, F.lit(_SLOTS)).cast("int")


def nodes_of(number: Column, levels: Column) -> Column:
    """The nodes of the given levels that hold a number."""
    return F.transform(levels, lambda l: _down(number.cast("bigint"), l) * _SLOTS + l)
