"""Document fingerprints: weighted SimHash, and search by permuted block tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from pitwall.llm.columns import free_name
from pitwall.llm.hamming import BITS, block_tables, blocks_for, distance, hex16, key_bits, packed, permuted, votes
from pitwall.sources.scratch import staged

#: Bytes of a text that are hashed at a time.
RUN = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that every bit of a hash depends on all of its input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_POWER = np.cumprod(np.full(2 * RUN + 2, _ODD))
_INVERSE = np.cumprod(np.full(2 * RUN + 2, np.uint64(pow(int(_ODD), -1, 1 << 64))))
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each blank-separated word: a polynomial over its bytes, taken from running sums, then scrambled."""
    out = []
    start = 0
    while start < len(text):
        end = min(start + RUN, len(text))
        while end < len(text) and end - start < 2 * RUN and text[end] not in b" \t\n\v\f\r":
            end += 1
        raw = np.frombuffer(text, np.uint8, end - start, start)
        blank = _BLANK[raw]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]])))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * _POWER[: len(raw)])])
        a, b = edges[::2], edges[1::2]
        out.append(_mixed((sums[b] - sums[a]) * _INVERSE[a] + (b - a).astype(np.uint64)))
        start = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def simhash(text: bytes) -> int:
    """The fingerprint of a UTF-8 text, ASCII case folded: its terms are pairs of neighbouring words (the word, where there is one only), weighted by the root of
    their number, and each term's hash votes with its weight for its set bits and against the others. Zero without words."""
    words = word_hashes(text.lower())
    if len(words) == 0:
        return 0
    terms = words if len(words) == 1 else _mixed(words[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + words[1:])
    terms, n = np.unique(terms, return_counts=True)
    weights = np.sqrt(n)
    return packed(votes(terms, weights) * 2 > weights.sum())


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> BITS - 1 else x


def fingerprinted(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of every row (all but the text by default) and its fingerprint as a long in the column fp. A null text counts as empty."""
    keep = keep if keep is not None else [c for c in docs.columns if c != text]
    body = free_name(docs, "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = pa.array([_signed(simhash(t.as_py() or b"")) for t in b.column(b.num_columns - 1)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], codes], names=[*b.schema.names[:-1], "fp"])

    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").cast("binary").alias(body))
    return rows.mapInArrow(run, rows.drop(body).withColumn("fp", F.lit(0).cast("long")).schema)


def neighbours(queries: DataFrame, values: DataFrame, radius: int, blocks: int) -> DataFrame:
    """All pairs (q, fp, bits) of a value of `queries.fp` and a value of `values.fp` that differ in at most `radius` bits.

    Both sides are put into every permuted block table; rows that agree on the leading blocks meet in one join by (table, key), and their distance is
    part of the join condition. A pair that several tables find is reported by the first of them. Values are made different before, so that many
    copies of one text are one row.
    """
    orders = block_tables(radius, blocks)

    def tables(df: DataFrame, name: str) -> DataFrame:
        rows = [F.struct(F.lit(i).alias("tab"), F.shiftrightunsigned(permuted(F.col(name), o), BITS - key_bits(o, radius, blocks)).alias("key")) for i, o in enumerate(orders)]
        return df.select(name, F.explode(F.array(*rows)).alias("t")).select(name, "t.tab", "t.key")

    q, v = tables(queries.select(F.col("fp").alias("q")).distinct(), "q"), tables(values.select("fp").distinct(), "fp")
    met = v.join(q, (v["tab"] == q["tab"]) & (v["key"] == q["key"]) & (distance(F.col("q"), F.col("fp")) <= radius))
    return met.select("q", "fp", distance(F.col("q"), F.col("fp")).alias("bits")).distinct()


def near_counts(fps: DataFrame, queries: DataFrame, radius: int) -> DataFrame:
    """For each different fp of `queries` the number of rows of `fps` within `radius` bits: columns q, n."""
    copies = fps.groupBy("fp").agg(F.count("*").alias("rows"))
    pairs = neighbours(queries, copies, radius, blocks_for(copies.count(), radius))
    return pairs.join(copies, "fp").groupBy("q").agg(F.sum("rows").alias("n"))


def edited_text(text: str, following: str) -> str:
    """The last half of the code points, rounded down, replaced by as many from the start of the following text, or by all of it where it is shorter."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_CLOSED, _HEAD, _OPEN = 0, 1, 2
_STEPS = "doc_id long, n_chars long, edited_sha256 string, fp long, edited_fp long, next_fp long, kind int, part int, text string"
_FIELDS = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fp", pa.int64()), ("edited_fp", pa.int64()), ("next_fp", pa.int64()),
                     ("kind", pa.int32()), ("part", pa.int32()), ("text", pa.string())])


def _edit(doc_id: int | None, text: str, fp: int, following: str, next_fp: int) -> dict:
    edited = edited_text(text, following).encode()
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited).hexdigest(), "fp": fp, "edited_fp": _signed(simhash(edited)), "next_fp": next_fp, "kind": _CLOSED, "part": None, "text": None}


def _in_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (doc_id, text): every row but the last meets the row after it; the first and the last row of the partition also go out with their texts."""
    last, part = None, TaskContext.get().partitionId()

    def edge(kind: int, row: tuple) -> dict:
        return {"doc_id": row[0], "n_chars": None, "edited_sha256": None, "fp": row[2], "edited_fp": None, "next_fp": None, "kind": kind, "part": part, "text": row[1]}

    for b in batches:
        out = []
        for doc_id, value in zip(b.column(0).to_pylist(), b.column(1)):
            text = value.as_py()
            row = (doc_id, text, _signed(simhash(text.encode())))
            out.append(edge(_HEAD, row) if last is None else _edit(*last, row[1], row[2]))
            last = row
        yield pa.RecordBatch.from_pylist(out, _FIELDS)
    if last is not None:
        yield pa.RecordBatch.from_pylist([edge(_OPEN, last)], _FIELDS)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_pylist([_edit(r["doc_id"], r["text"], r["fp"], r["after"], r["after_fp"]) for r in b.to_pylist()], _FIELDS)


def with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp.

    The next document is the one after it by descending doc_id, null ids last, equal ids by text; after the last comes the first. A null text counts
    as empty, and a lone document is its own next. Texts move once, range-partitioned by id. Where a partition ends, its last document meets the first
    of the next partition that has one: these rows, two per partition, are the only ones kept with their texts.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    line = rows.repartitionByRange(F.col("doc_id").desc_nulls_last()).sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "text")
    steps = staged(line.mapInArrow(_in_line, _STEPS), "edits")
    heads = steps.filter(F.col("kind") == _HEAD).select("part", F.struct("text", "fp").alias("after"))
    # which partition comes after which is one number each; the texts stay where they are until they meet
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = heads.select(F.col("part").alias("before"), F.coalesce(F.lead("part").over(order), F.first("part").over(whole)).alias("part"))
    after = heads.join(following, "part").select(F.col("before").alias("head_part"), "after")
    ends = steps.filter(F.col("kind") == _OPEN).join(after, F.col("part") == F.col("head_part"))
    closed = ends.select("doc_id", "text", "fp", F.col("after.text").alias("after"), F.col("after.fp").alias("after_fp")).mapInArrow(_close, _STEPS)
    return steps.filter(F.col("kind") == _CLOSED).union(closed).drop("kind", "part", "text")


def digest(docs: DataFrame, radius: int = 3, every: int = 100) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near.

    Likeness is the share of equal bits. n_near, for documents whose id is divisible by `every`, is the number of documents, itself included, whose
    fingerprint is within `radius` bits; null for all others.
    """
    rows = staged(with_edits(docs), "fingerprints")
    asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    found = near_counts(rows.select("fp"), rows.filter(asked).select("fp"), radius)
    told = rows.filter(asked).join(found, F.col("fp") == F.col("q"), "left").drop("q").unionByName(rows.filter(~asked).withColumn("n", F.lit(None).cast("long")))

    def likeness(other: str):
        return 1 - distance(F.col("fp"), F.col(other)) / BITS

    return told.select("doc_id", "n_chars", "edited_sha256", hex16(F.col("fp")).alias("fingerprint"), hex16(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness("edited_fp").alias("near_edited"), likeness("next_fp").alias("near_next"), F.col("n").alias("n_near"))
