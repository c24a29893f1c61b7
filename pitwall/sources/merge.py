"""Upsert and incremental loads on plain Parquet tables."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitwall.operators.rows import qualify_first
from pitwall.schemas import DEFAULT_MERGE_KEY, MERGE_KEYS, partition_key
from pitwall.settings import DEFAULTS
from pitwall.sources.files import children, move, read_text, write_text
from pitwall.sources.scratch import path_exists, remove_path

STAMPS = ("created_at", "updated_at")
#: Folder of a table that holds loads not yet swapped in, and the list of a swap; readers skip names with an underscore.
PENDING, SWAP = "_pending", "_swap.json"


def _on(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`") == F.col(f"{right}.`{k}`") for k in keys])


def require_keys(keys: Sequence[str], **tables: DataFrame) -> None:
    """ValueError when a merge key is missing from a table."""
    missing = {name: [k for k in keys if k not in df.columns] for name, df in tables.items()}
    if not keys or any(missing.values()):
        raise ValueError(f"missing merge keys: {missing if keys else 'none given'}")


def one_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence | None) -> DataFrame:
    """The batch with each key once: its first row by `order`.  Without an order a repeated key is an error.

    Rows with a NULL in their key match nothing, so all of them stay.
    """
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if order:
        return qualify_first(batch.filter(whole), keys, order).unionByName(batch.filter(~whole))
    repeated = batch.filter(whole).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"the batch holds a key more than once and no order to choose by: {repeated[0]}")
    return batch


def merge_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], now: datetime.datetime | None = None) -> DataFrame:
    """Target after the batch, which holds each key once: matched rows take the batch's values, new rows are added.

    NULL keys never match.  Columns the batch lacks keep their stored value.  `created_at` of a matched row stays, `updated_at` is stamped, if the
    target has them.  A key stored twice, as a lost run may leave it, is stored once after.
    """
    stamp = F.lit(now).cast("timestamp_ntz") if now else F.current_timestamp().cast("timestamp_ntz")
    given = [c for c in target.columns if c in batch.columns and c not in STAMPS]
    rest = [c for c in target.columns if c not in given]
    kept = target.alias("t").join(batch.select(*keys).alias("b"), _on(keys, "t", "b"), "left_anti")
    held = target.join(batch.select(*keys), list(keys), "left_semi").groupBy(*keys).agg(F.min(F.struct(F.lit(True).alias("_hit"), *rest)).alias("_held"))
    new = batch.select(*given).alias("b").join(held.alias("h"), _on(keys, "b", "h"), "left")
    hit = F.col("h._held").isNotNull()

    def value(c: str) -> Column:
        if c in given:
            return F.col(f"b.`{c}`")
        old = F.col(f"h._held.`{c}`")
        if c == "created_at":
            return F.when(hit, old).otherwise(stamp)
        return stamp if c == "updated_at" else old

    return kept.select(*target.columns).unionByName(new.select(*[value(c).alias(c) for c in target.columns]))


def in_partitions(partition: str, values: Sequence) -> Column:
    """A filter on literal partition values, NULL included, that prunes folders."""
    known = [v for v in values if v is not None]
    found = F.col(partition).isin(known) if known else F.lit(False)
    return found | F.col(partition).isNull() if len(known) < len(values) else found


def upsert(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition: str, order: Sequence | None = None,
    sync_columns: bool = False, now: datetime.datetime | None = None,
) -> None:
    """Merges a batch into the Parquet table at `path`, rewriting only the partitions the batch touches.

    Touched are the partitions of the batch's rows and, unless the partition is part of the key, those where its keys are stored now, found by a scan of
    the keys alone: a row whose partition value changes moves.  Their values, one per partition, become literals in the scan of the target, so other
    folders aren't read.  A NULL partition value is a partition like any other.  A repeated key in the batch needs `order`.

    The merged partitions are written once, aside in the table's own folder, where readers don't look.  A list of the swap is put beside them before the first
    stored folder goes, and the swap renames folders; a run that is lost before the list changed nothing, one that is lost after it is finished by the next
    (`finish_swap`), so at no time is the only copy of a row removed.  A table has one writer at a time.  Amidst a swap a reader may find a partition missing;
    `versions.VersionedTable` is for tables whose readers must not.  `sync_columns` adds columns the table does not have yet, NULL for its older rows; read such
    a table with `read_synced`.
    """
    require_keys(keys, batch=batch)
    finish_swap(spark, path)
    batch = batch.persist()
    try:
        merged, held = one_per_key(batch, keys, order), []
        if has_rows(spark, path):
            target = read_synced(spark, path) if sync_columns else spark.read.parquet(path)
            require_keys(keys, target=target)
            if sync_columns:
                target = target.unionByName(batch.limit(0), allowMissingColumns=True)
            kind = target.schema[partition].dataType
            touched = merged.select(F.col(partition).cast(kind))
            if partition not in keys:
                touched = touched.union(target.select(*keys, partition).join(batch.select(*keys), list(keys), "left_semi").select(partition))
            values = [r[0] for r in touched.distinct().collect()]
            stored = target.filter(in_partitions(partition, values))
            files = spark.read.parquet(path).filter(in_partitions(partition, values)).select(F.regexp_extract("_metadata.file_path", "/([^/]+)/[^/]*$", 1).alias("folder"))
            held = [r[0] for r in files.distinct().collect()]
            merged = merge_rows(stored, merged.withColumn(partition, F.col(partition).cast(kind)), keys, now)
        aside = f"{path}/{PENDING}/{uuid.uuid4().hex}"
        # rebalancing by partition avoids many small files and splits a partition that holds most rows
        merged.hint("rebalance", partition).write.partitionBy(partition).parquet(aside)
        made = [n for n in children(spark, aside) if n.startswith(f"{partition}=")]
        write_text(spark, f"{aside}/{SWAP}.tmp", json.dumps({"made": made, "gone": [f for f in held if f not in made]}))
        move(spark, f"{aside}/{SWAP}.tmp", f"{aside}/{SWAP}")
    finally:
        batch.unpersist()
    finish_swap(spark, path)


def finish_swap(spark: SparkSession, path: str) -> None:
    """Completes the swap of a run that was lost amidst it, and removes what a run left that was lost before."""
    pending = f"{path}/{PENDING}"
    for load in children(spark, pending):
        aside = f"{pending}/{load}"
        held = children(spark, aside)
        if SWAP in held:
            swap = json.loads(read_text(spark, f"{aside}/{SWAP}"))
            for folder in swap["gone"]:
                remove_path(spark, f"{path}/{folder}")
            for folder in swap["made"]:
                # a folder that isn't aside any more is in place
                if folder in held:
                    remove_path(spark, f"{path}/{folder}")
                    move(spark, f"{aside}/{folder}", f"{path}/{folder}")
        remove_path(spark, aside)
    if path_exists(spark, pending):
        remove_path(spark, pending)


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a table was ever loaded there: its folder has more than what a load keeps aside."""
    return any(not n.startswith(("_", ".")) for n in children(spark, path))


def merge_feed(spark: SparkSession, path: str, batch: DataFrame, feed: str, order: Sequence | None = None, now: datetime.datetime | None = None) -> None:
    """Upserts landed rows of a feed by the feed's own merge key, partitioned by session (meetings by meeting)."""
    upsert(spark, path, batch, MERGE_KEYS.get(feed, DEFAULT_MERGE_KEY), partition_key(feed), order, now=now)


def read_synced(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files may have different columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def lookback_bound(spark: SparkSession, path: str, at: str, days: int = DEFAULTS.lookback_days) -> datetime.datetime | None:
    """Latest stored time minus the look-back; None for a table that does not exist yet."""
    finish_swap(spark, path)
    if not has_rows(spark, path):
        return None
    newest = spark.read.parquet(path).agg(F.max(at)).first()[0]
    return (newest or datetime.datetime(1900, 1, 1)) - datetime.timedelta(days=days)


def incremental_load(
    spark: SparkSession, path: str, build: Callable[[datetime.datetime | None], DataFrame], keys: Sequence[str], at: str, partition: str,
    days: int = DEFAULTS.lookback_days, order: Sequence | None = None,
) -> None:
    """Builds the rows newer than the look-back bound and merges them.

    The bound is a literal in the plan of `build`, so it prunes partitions and row groups.  Rows that arrive
    later than the look-back need a full rebuild.
    """
    upsert(spark, path, build(lookback_bound(spark, path, at, days)), keys, partition, order)
