"""Tables whose loads are whole or not there at all.

A load writes the partitions it changes as new files, then a manifest that names, for each partition of the table, the load that holds it; renaming this
manifest to the next version number makes it current, all partitions at once.  Nothing that a reader may have open is touched: readers take the files of
one version, and `vacuum` removes what no kept version names.  A load that breaks off anywhere leaves the version before it.

The rename must not replace an existing file and must be atomic, as it is in HDFS and local file systems; an object store without such a rename needs a
committer of its own for the manifest.  A manifest has one entry per partition.
"""

from __future__ import annotations

import datetime
import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pitwall.sources.files import children, modified_ms, move, read_text, write_text
from pitwall.sources.merge import in_partitions, merge_rows, one_per_key, require_keys
from pitwall.sources.scratch import remove_path

LOAD = "_load"
HOUR_MS = 3_600_000


class ConflictError(RuntimeError):
    """Another load changed a partition that this one read or replaced; its files are left to `vacuum`, the table has the other load's rows."""


@dataclass(frozen=True)
class Manifest:
    """One version of a table: its schema, and per partition folder the load whose files it is made of."""

    version: int = 0
    schema: T.StructType | None = None
    partitions: dict[str, str] = field(default_factory=dict)


class VersionedTable:
    """A Parquet table under `root`, partitioned by one column or not at all."""

    def __init__(self, spark: SparkSession, root: str, partition: str | None):
        self.spark, self.root, self.partition = spark, root.rstrip("/"), partition

    # --- reading

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in children(self.spark, f"{self.root}/manifests") if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self, version: int | None = None) -> Manifest:
        """A version's manifest, the current one's by default; an empty one for a table without versions."""
        known = self.versions()
        if version is None and not known:
            return Manifest()
        number = known[-1] if version is None else version
        held = json.loads(read_text(self.spark, self._manifest_path(number)))
        return Manifest(number, T.StructType.fromJson(held["schema"]), held["partitions"])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the current one by default.  The plan keeps naming this version's files, whatever is loaded later."""
        m = self.manifest(version)
        if m.schema is None:
            raise FileNotFoundError(f"{self.root} has no version")
        return self._scan(m).select(*[f"`{c}`" for c in m.schema.fieldNames()])

    def _scan(self, m: Manifest) -> DataFrame:
        """The version's files, as read; the column of the load comes with the partition."""
        schema = T.StructType([*m.schema.fields, T.StructField(LOAD, T.StringType())])
        if not m.partitions:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.root}/data/{LOAD}={load}/{folder}".rstrip("/") for folder, load in m.partitions.items()]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*folders)

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:012d}.json"

    # --- loading

    def replace(self, rows: DataFrame, everything: bool = False) -> int:
        """The partitions present in `rows` get these rows, others stay; `everything` drops the others.  Returns the new version."""
        base = self.manifest()
        schema = rows.schema if base.schema is None or everything else base.schema
        conformed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields])
        load, folders = self._write(conformed)
        return self._commit(base, schema, load, folders, gone=list(base.partitions) if everything else [], read=[])

    def delete(self, values: Iterable) -> int:
        """Removes whole partitions; values without rows are ignored."""
        base = self.manifest()
        folders = self._folders(base, list(values))
        return self._commit(base, base.schema, "", [], gone=folders, read=[]) if folders else base.version

    def upsert(self, batch: DataFrame, keys: Sequence[str], order: Sequence | None = None, sync_columns: bool = False, now: datetime.datetime | None = None) -> int:
        """Merges a batch by its keys, as `merge.merge_rows` does, and returns the new version.

        Touched are the partitions of the batch's rows and those its keys are stored in now, so rows may move; each is written once.  `sync_columns` adds
        the batch's further columns, NULL in older rows.
        """
        require_keys(keys, batch=batch)
        base = self.manifest()
        batch = batch.persist()
        try:
            merged = one_per_key(batch, keys, order)
            if base.schema is None:
                load, folders = self._write(merged)
                return self._commit(base, merged.schema, load, folders, gone=[], read=[])
            target = self._scan(base).select(*[f"`{c}`" for c in base.schema.fieldNames()])
            require_keys(keys, target=target)
            schema = base.schema
            if sync_columns:
                schema = T.StructType([*schema.fields, *[f for f in batch.schema.fields if f.name not in schema.fieldNames()]])
                target = target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[len(base.schema.fields):]])
            if self.partition is None:
                stored, touched = target, list(base.partitions)
            else:
                kind = base.schema[self.partition].dataType
                places = merged.select(F.col(self.partition).cast(kind))
                if self.partition not in keys:
                    places = places.union(target.select(*keys, self.partition).join(batch.select(*keys), list(keys), "left_semi").select(self.partition))
                values = [r[0] for r in places.distinct().collect()]
                stored = target.filter(in_partitions(self.partition, values))
                merged = merged.withColumn(self.partition, F.col(self.partition).cast(kind))
                touched = self._folders(base, values)
            load, folders = self._write(merge_rows(stored.select(*schema.fieldNames()), merged, keys, now))
            # where rows may move, each partition was looked through for the batch's keys
            return self._commit(base, schema, load, folders, gone=touched, read=touched if self.partition in keys else None)
        finally:
            batch.unpersist()

    def _folders(self, m: Manifest, values: list) -> list[str]:
        """The version's folders of some partition values, one row each, found by their files' paths."""
        if not m.partitions or self.partition is None:
            return list(m.partitions)
        paths = self._scan(m).filter(in_partitions(self.partition, values)).select(F.regexp_extract("_metadata.file_path", "/([^/]+)/[^/]+$", 1).alias("folder"))
        return [r[0] for r in paths.distinct().collect()]

    def _write(self, rows: DataFrame) -> tuple[str, list[str]]:
        """Writes a load's files; nothing refers to them yet."""
        load = uuid.uuid4().hex
        where = f"{self.root}/data/{LOAD}={load}"
        if self.partition is None:
            rows.write.parquet(where)
            return load, [""]
        # rebalancing by partition avoids many small files and splits a partition that holds most rows
        rows.hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(where)
        return load, [n for n in children(self.spark, where) if n.startswith(f"{self.partition}=")]

    def _commit(self, base: Manifest, schema: T.StructType, load: str, folders: list[str], gone: list[str], read: list[str] | None) -> int:
        """Makes a load current: the base version without the folders `gone`, with the load's.

        When another load was faster, this one goes on top of it, unless both changed a partition, or the other changed one that this one's rows were
        computed from (`read`; all, when it is None).
        """
        while True:
            entries = {k: v for k, v in base.partitions.items() if k not in set(gone)} | dict.fromkeys(folders, load)
            number = base.version + 1
            aside = f"{self.root}/manifests/.{uuid.uuid4().hex}.tmp"
            write_text(self.spark, aside, json.dumps({"schema": schema.jsonValue(), "partitions": entries}))
            try:
                move(self.spark, aside, self._manifest_path(number))
                return number
            except FileExistsError:
                remove_path(self.spark, aside)
                newer = self.manifest()
                mine = {*folders, *gone, *(read if read is not None else {*base.partitions, *newer.partitions})}
                if newer.schema != base.schema or any(newer.partitions.get(k) != base.partitions.get(k) for k in mine):
                    raise ConflictError(f"version {newer.version} of {self.root} changed a partition of this load") from None
                base = newer

    # --- upkeep

    def vacuum(self, keep: int = 1, idle_hours: float = 24.0, clock_ms: Callable[[], int] = lambda: int(time.time() * 1000)) -> list[str]:
        """Removes all but the last `keep` versions and the loads that no kept version names; returns these loads.

        A load younger than `idle_hours` stays: it may be one that is still being written, or one a reader has open.
        """
        known = self.versions()
        for old in known[:-keep]:
            remove_path(self.spark, self._manifest_path(old))
        named = {load for v in known[-keep:] for load in self.manifest(v).partitions.values()}
        out = []
        for folder in children(self.spark, f"{self.root}/data"):
            where = f"{self.root}/data/{folder}"
            if folder.startswith(f"{LOAD}=") and folder[len(LOAD) + 1:] not in named and clock_ms() - modified_ms(self.spark, where) >= idle_hours * HOUR_MS:
                remove_path(self.spark, where)
                out.append(folder[len(LOAD) + 1:])
        return out
