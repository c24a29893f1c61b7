"""Stream sinks: append tables, topics, merges, windows kept up to date, counters.

Sinks that write by micro-batch put each batch into folders of its own number, so a batch that runs again replaces what it wrote before.  None of them
forgets: a record counts however late it comes, and what is kept between batches is the table itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pitwall.sources.landing import split_valid
from pitwall.sources.merge import in_partitions, one_per_key, upsert
from pitwall.sources.scratch import path_exists
from pitwall.streaming.keyed import LATE, started
from pitwall.streaming.state import window_start

BATCH = "batch_id"


def append_table(stream: DataFrame, path: str, checkpoint: str, partition: str | None = "event_date", once: bool = False) -> StreamingQuery:
    """Appends to a Parquet table with exactly-once file commits."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if partition:
        writer = writer.partitionBy(partition)
    return _start(writer, once)


def to_topic(stream: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Writes `key` and `value` to a topic; needs Spark's Kafka connector."""
    writer = stream.select("key", "value").writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return _start(writer.option("topic", topic).option("checkpointLocation", checkpoint), False)


def merge_table(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], partition: str, order: Sequence, prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    once: bool = False,
) -> StreamingQuery:
    """Upserts every micro-batch; running a batch again leaves the same table."""
    return _each_batch(stream, checkpoint, lambda batch, _: upsert(batch.sparkSession, path, prepare(batch), keys, partition, order), once)


def _put(rows: DataFrame, path: str, batch_id: int, partition: Sequence[str] = ()) -> None:
    numbered = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition, BATCH).parquet(path)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """A table written batch by batch."""
    return spark.read.parquet(path).drop(BATCH)


def _each_batch(stream: DataFrame, checkpoint: str, put: Callable[[DataFrame, int], None], once: bool, mode: str = "append") -> StreamingQuery:
    def held(batch: DataFrame, batch_id: int) -> None:
        # used several times below; read from the source once
        batch = batch.persist()
        try:
            put(batch, batch_id)
        finally:
            batch.unpersist()

    return _start(stream.writeStream.foreachBatch(held).outputMode(mode).option("checkpointLocation", checkpoint), once)


def append_new(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], partition: str, order: Sequence, once: bool = False) -> StreamingQuery:
    """Appends the records whose key the table doesn't hold; of a batch the first by `order`.  The partition must follow from the key: only the
    batch's own partitions are read."""

    def put(batch: DataFrame, batch_id: int) -> None:
        new = one_per_key(batch, keys, order)
        if path_exists(batch.sparkSession, path):
            days = [r[0] for r in batch.select(partition).distinct().collect()]
            held = batch.sparkSession.read.parquet(path).filter(in_partitions(partition, days) & (F.col(BATCH) != batch_id))
            new = new.join(held.select(*keys), list(keys), "left_anti")
        _put(new, path, batch_id, [partition])

    return _each_batch(stream, checkpoint, put, once)


def keep_windows(
    stream: DataFrame, rows_path: str, path: str, checkpoint: str, keys: Sequence[str], at: str, width: str, build: Callable[[DataFrame], DataFrame], once: bool = False
) -> StreamingQuery:
    """Appends all records to a table, and keeps a second one of their windows: every batch rebuilds the windows it touches from all their stored
    records.  `build` makes windows (keys, window_start, values) of records; a window lies within one `event_date`.  Records with a NULL in a key are
    stored but are in no window."""

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _put(batch, rows_path, batch_id, ["event_date"])
        touched = batch.dropna(subset=list(keys)).withColumn("window_start", window_start(at, width)).select(*keys, "window_start").distinct()
        days = [r[0] for r in batch.select("event_date").distinct().collect()]
        stored = read_batches(spark, rows_path).filter(in_partitions("event_date", days)).withColumn("window_start", window_start(at, width))
        windows = build(stored.join(touched, [*keys, "window_start"], "left_semi").drop("window_start"))
        upsert(spark, path, windows.withColumn("event_date", F.to_date("window_start")), [*keys, "window_start", "event_date"], "event_date")

    return _each_batch(stream, checkpoint, put, once)


def merge_windows(stream: DataFrame, path: str, late_path: str, checkpoint: str, keys: Sequence[str], once: bool = False) -> StreamingQuery:
    """Keeps the windows of `keyed.per_window` in a table, each with its latest state, and appends the late records to another."""

    def put(batch: DataFrame, batch_id: int) -> None:
        windows = batch.filter(~F.col(LATE)).drop(LATE).withColumn("event_date", F.to_date("window_start"))
        _put(batch.filter(LATE).drop(LATE), late_path, batch_id)
        upsert(batch.sparkSession, path, windows, [*keys, "window_start", "event_date"], "event_date")

    return started(stream.sparkSession, lambda: _each_batch(stream, checkpoint, put, once, mode="update"))


def append_observed(stream: DataFrame, path: str, counts_path: str, checkpoint: str, required: Sequence[str], at: str, partition: str = "event_date", once: bool = False) -> StreamingQuery:
    """Appends records that have all required fields; how many there were, how many were written, and their first and last time are observed by the write itself.

    The batch is read once and not held: the counts come out of the same pass as the files, one row per batch.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        whole = F.lit(True)
        for c in required:
            whole = whole & F.col(c).isNotNull()
        seen = Observation()
        good, _ = split_valid(batch.observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if(whole).alias("inserted"), F.min(at).alias("first_at"), F.max(at).alias("last_at")), required)
        _put(good, path, batch_id, [partition])
        told = seen.get
        row = (told["processed"], told["inserted"], told["first_at"], told["last_at"])
        _put(batch.sparkSession.createDataFrame([row], "processed bigint, inserted bigint, first_at timestamp_ntz, last_at timestamp_ntz"), counts_path, batch_id)

    return _start(stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint), once)


def append_counted(
    stream: DataFrame, path: str, counts_path: str, checkpoint: str, required: Sequence[str], by: Sequence[str], partition: str = "event_date", once: bool = False
) -> StreamingQuery:
    """Appends records that have all required fields, and counts per batch and group those processed and those inserted."""

    def put(batch: DataFrame, batch_id: int) -> None:
        good, _ = split_valid(batch, required)
        _put(good, path, batch_id, [partition])
        whole = F.lit(True)
        for c in required:
            whole = whole & F.col(c).isNotNull()
        _put(batch.groupBy(*by).agg(F.count("*").alias("processed"), F.count_if(whole).alias("inserted")), counts_path, batch_id)

    return _each_batch(stream, checkpoint, put, once)


def progress(spark: SparkSession, counts_path: str, by: Sequence[str]) -> DataFrame:
    """Records processed and inserted so far, and batches, per group: summed from what the sink has written, so it covers every batch."""
    counts = spark.read.parquet(counts_path)
    return counts.groupBy(*by).agg(F.sum("processed").alias("processed"), F.sum("inserted").alias("inserted"), F.count_distinct(BATCH).alias("batches"))


def _start(writer, once: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Waits for a run over the available data to end; raises its error."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query
