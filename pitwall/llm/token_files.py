"""Token-id output: flat unsigned integer files with 64-bit document offsets, written and read by Spark tasks.

A data set is a folder of shards. Shard `p` holds
  tokens-<p>.bin   ids of its documents one after the other, little-endian, 2 or 4 bytes each,
  offsets-<p>.bin  unsigned 64-bit: where each document begins within the shard, counted in ids, and the shard's length at the end,
  ids-<p>.bin      signed 64-bit doc_id of each document; documents without an id come first in the data set and their number is in the manifest,
and manifest/ is a Parquet table with one row per shard and `base`, the ids in all shards before it.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from pitwall.llm.encoder import encoder

MANIFEST = "shard int, attempt string, n_docs long, n_null long, n_tokens long, width int, first_id long"
READ_ROWS = 4096


#: What other file systems call stores that pyarrow has a name of its own for.
SCHEMES = {"s3a": "s3", "s3n": "s3", "file": "file", "s3": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfss": "abfss", "abfs": "abfs"}


def qualified(spark: SparkSession, root: str) -> str:
    """The folder with the scheme of its file system: a path without one is in Hadoop's default file system, as it is for Spark's own files.

    ValueError for a file system whose files pyarrow can't open, before any task runs.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    scheme, _, rest = full.partition(":")
    if scheme not in SCHEMES:
        raise ValueError(f"token files can't be written to {scheme}: folders; take one of {', '.join(sorted(SCHEMES))}")
    full = f"{SCHEMES[scheme]}:{rest}"
    try:
        _filesystem(full)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as e:
        raise ValueError(f"token files can't be written to {root}: {e}") from e
    return full


def _filesystem(root: str):
    """The file system of a qualified folder and the folder's path in it."""
    from pyarrow import fs

    # Hadoop writes file:/path
    return fs.FileSystem.from_uri("file://" + root[5:] if root.startswith("file:/") and not root.startswith("file://") else root)


def write(docs: DataFrame, root: str, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text (null: empty), end each with `end_id`, and write the shards in ascending doc_id order, null ids first.

    Rows are range-partitioned by id, one shard per partition; equal ids are ordered by text. A task streams its rows to files named by its
    attempt, and only the manifest of finished tasks names files, so a repeated or lost task leaves no wrong shard. Bases are prefix sums over
    the shards' lengths: one row per shard.
    """
    spark = docs.sparkSession
    files_root = qualified(spark, root)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, attempt = encoder(vocabulary), TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        files, folder = _filesystem(files_root)
        n, n_null, at, first, out = 0, 0, 0, None, {}
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            if not ids:
                continue
            if not out:
                files.create_dir(folder, recursive=True)
                out = {k: files.open_output_stream(f"{folder}/{k}-{shard}-{attempt}.bin") for k in ("tokens", "offsets", "ids")}
                first = ids[0]
            for data, lengths in enc.runs(texts, end_id):
                out["tokens"].write(data.tobytes())
                out["offsets"].write((at + np.cumsum(lengths) - lengths).astype("<u8").tobytes())
                at += len(data)
            out["ids"].write(np.array([0 if x is None else x for x in ids], "<i8").tobytes())
            n, n_null = n + len(ids), n_null + sum(x is None for x in ids)
        if out:
            out["offsets"].write(np.array([at], "<u8").tobytes())
            for f in out.values():
                f.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "attempt": attempt, "n_docs": n, "n_null": n_null, "n_tokens": at, "width": enc.dtype.itemsize, "first_id": first}], _schema())

    rows.mapInArrow(run, MANIFEST).write.parquet(f"{root}/written")
    shards = spark.read.schema(MANIFEST).parquet(f"{root}/written")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long")).write.parquet(f"{root}/manifest")


def _schema() -> pa.Schema:
    return pa.schema([("shard", pa.int32()), ("attempt", pa.string()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32()), ("first_id", pa.int64())])


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST + ", base long").parquet(f"{root}/manifest")


class Numbers:
    """A shard file of unsigned or signed integers: memory-mapped where the folder is mounted, else read range by range from its store."""

    def __init__(self, root: str, name: str, dtype: str):
        from pyarrow import fs

        files, folder = _filesystem(root)
        self.dtype, self.file, self.mapped = np.dtype(dtype), None, np.zeros(0, dtype)
        if not isinstance(files, fs.LocalFileSystem):
            self.file = files.open_input_file(f"{folder}/{name}")
        elif os.path.getsize(path := os.path.join(folder, name)):
            self.mapped = np.memmap(path, dtype, "r")

    def __getitem__(self, span: slice) -> np.ndarray:
        if self.file is None:
            return self.mapped[span]
        return np.frombuffer(self.file.read_at((span.stop - span.start) * self.dtype.itemsize, span.start * self.dtype.itemsize), self.dtype)


def documents(spark: SparkSession, root: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start (ids before it in the data set), n_tokens, ids_crc32 of its ids as 32-bit integers, and with
    `with_ids` the ids as an array. Shards are read in runs of READ_ROWS documents, eight to a task, within what the session's parallelism can use."""
    files_root = qualified(spark, root)
    parts = manifest(spark, root).withColumn("from_row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(READ_ROWS).cast("long"))))
    parts = parts.repartition(min(1 + parts.count() // 8, 16 * spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                part, begin = f"{r['shard']}-{r['attempt']}.bin", r["from_row"]
                n = min(READ_ROWS, r["n_docs"] - begin)
                offsets = Numbers(files_root, f"offsets-{part}", "<u8")[begin : begin + n + 1].astype(np.int64)
                ids = Numbers(files_root, f"ids-{part}", "<i8")[begin : begin + n]
                data, crc, lists = Numbers(files_root, f"tokens-{part}", f"<u{r['width']}"), np.empty(n, np.int64), []
                for i in range(n):
                    tokens = data[int(offsets[i]) : int(offsets[i + 1])].astype("<u4")
                    crc[i] = zlib.crc32(tokens.tobytes())
                    if with_ids:
                        lists.append(tokens.astype(np.int64))
                nulls = np.arange(begin, begin + n) < r["n_null"]
                columns = [pa.array(ids.astype(np.int64), mask=nulls), pa.array(offsets[:-1] + r["base"]), pa.array(np.diff(offsets)), pa.array(crc)]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(lists, pa.list_(pa.int64()))] if with_ids else []), names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    return parts.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
