"""Keyed stream state that forgets by itself, with what came too late as an output of its own.

A watermark drops late rows without a word; here every row of the stream comes out, as part of a window or marked late, so a sink can put the two into tables
of their own and a later run can merge them.  State is a window's latest record per key, kept until the key's own events have moved on by a delay; a time to
live forgets keys that fell silent.  The state store must be RocksDB, which `started` sees to.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: Marks rows of the late output.
LATE = "late"
SECOND_US = 1_000_000
#: Rows of one key that are put in order of time together.
CHUNK = 10_000
_EPOCH, _MICROSECOND = datetime.datetime(1970, 1, 1), datetime.timedelta(microseconds=1)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _micros(at: datetime.datetime) -> int:
    return (at - _EPOCH) // _MICROSECOND


class _Windows(StatefulProcessor):
    """Per key the first or last record of each window that is still open.

    All a key holds is one value, so a key costs one read and one write in a micro-batch, whatever its windows.
    """

    def __init__(self, keys: Sequence[str], at: str, schema: StructType, width_us: int, delay_us: int, forget_ms: int | None, last: bool):
        self.at, self.names = at, [f.name for f in schema.fields if f.name not in keys]
        self.value = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema.fields if f.name not in keys)
        self.width, self.delay, self.forget, self.last = width_us, delay_us, forget_ms, last
        i = self.names.index(at)
        self.sequence = [i, *range(i), *range(i + 1, len(self.names))]
        self.columns = [*keys, "window_start", *self.names, LATE]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", f"high bigint, open array<struct<start: bigint, record: struct<{self.value}>>>", ttlDurationMs=self.forget)

    def _order(self, values: Sequence) -> tuple:
        """Records in order of time, then of all other values, NULL first; the same for rows and for what state holds."""
        return tuple((values[i] is not None, 0 if values[i] is None else values[i]) for i in self.sequence)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        known = self.held.get()
        high, open_ = (known[0], {start: tuple(record) for start, record in known[1]}) if known else (None, {})
        changed: set[int] = set()
        rows, late, places = iter(rows), [], None
        while chunk := list(islice(rows, CHUNK)):
            places = places or [chunk[0].__fields__.index(n) for n in self.names]
            records = (tuple(None if r[i] != r[i] else r[i] for i in places) for r in chunk)
            for us, values in sorted(((_micros(v[self.sequence[0]]), v) for v in records), key=lambda r: r[0]):
                start = us - us % self.width
                # a window is closed when the key's events have moved on by `delay` beyond its end
                if high is not None and start + self.width + self.delay <= high:
                    late.append((start, values))
                    continue
                high = us if high is None else max(high, us)
                held = open_.get(start)
                if held is None or (mine := self._order(values)) != (theirs := self._order(held)) and (mine > theirs) == self.last:
                    open_[start] = values
                    changed.add(start)
        if high is not None:
            still = [(start, values) for start, values in open_.items() if start + self.width + self.delay > high]
            self.held.update((high, still))
        row = Row(*self.columns)
        for is_late, out in ((False, ((start, open_[start]) for start in changed)), (True, late)):
            for start, values in out:
                yield row(*key, _EPOCH + start * _MICROSECOND, *values, is_late)


def per_window(stream: DataFrame, keys: Sequence[str], at: str, width_s: int, delay_s: int, forget_s: int | None = None, last: bool = True) -> DataFrame:
    """The keys, `window_start`, the record's other columns and LATE: after each micro-batch the last (or first) record of every window that changed, and every
    record whose window was closed, marked late.

    Of records at one time the largest (smallest) by the other columns counts.  Records with a NULL key or time come to no window and are left out.  Times are
    zone-less.  State per key is at most the windows of `delay_s` and one more.  With `forget_s` what wasn't written for so long goes too, which needs a query that
    keeps running: one over the available data would wait for time to pass, and so has to leave silent keys in its state.
    """
    given = stream.dropna(subset=[*keys, at])
    shape = StructType([*[given.schema[k] for k in keys], *[f for f in given.schema.fields if f.name not in keys]])
    columns = ", ".join([*[f"`{k}` {shape[k].dataType.simpleString()}" for k in keys], "window_start timestamp_ntz", *[f"`{f.name}` {f.dataType.simpleString()}" for f in shape.fields if f.name not in keys], f"{LATE} boolean"])
    processor = _Windows(keys, at, shape, width_s * SECOND_US, delay_s * SECOND_US, forget_s and forget_s * 1000, last)
    return given.groupBy(*keys).transformWithState(processor, columns, "Update", "ProcessingTime" if forget_s else "None")


def started(spark: SparkSession, start: Callable):
    """Starts a query whose state needs RocksDB; other queries of the session keep the store they are set to."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def reconciled(windows: DataFrame, late: DataFrame, keys: Sequence[str], at: str, last: bool = True) -> DataFrame:
    """What the windows would be had nothing been late: the last (first) of each window's record and its late ones."""
    both = windows.unionByName(late.select(*windows.columns))
    rest = [c for c in windows.columns if c not in (*keys, "window_start", at)]
    best = (F.max if last else F.min)(F.struct(at, *rest)).alias("_best")
    return both.groupBy(*keys, "window_start").agg(best).select(*keys, "window_start", "_best.*")
