"""Suffix-array removal of passages that repeat across documents.

A byte goes when it lies in a window of `length` bytes that also starts in a document with a smaller id. Windows are compared by their bytes, in suffix order;
what is spread over the cluster is chosen so that equal windows meet in one task and few others are moved:

1. Texts are packed into blocks and written once. Each window's seed is the least hash of the 24-byte strings in it, so equal windows have equal seeds, and
   windows that follow each other mostly share one. A block reports its distinct seeds, four bytes each; a seed that one document of the corpus has is
   followed no further.
2. The runs of windows with a shared seed go to the task of their seed, each different run of a block once, with the least id that has it. There all windows of
   different runs are sorted (`suffix_sort`), and the least id of every group of equal windows says which windows an earlier document holds. A seed that very
   many blocks have (a common line stands beside a different neighbour in each document) is no key: its windows are dealt out one by one by their own hash.
3. Blocks meet the answers about their runs; documents lose the bytes.

What a task holds is bounded by blocks and by text per bucket, not by how often a passage occurs: copies inside a block are one run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from pitwall.llm.suffix_sort import sort_windows
from pitwall.sources.scratch import staged

#: Bytes of a removed window.
LENGTH = 50
#: Bytes of the strings whose least hash is a window's seed; shorter windows take their own half.
SEED_BYTES = 24
#: Bytes of text in a block, at least unless the partition ends; one document is never split.
BLOCK = 4 << 20
#: Bytes of text for which one bucket of seeds is made.
BUCKET = 4 << 20
#: Blocks that may share a seed before its windows are dealt out one by one.
COMMON = 512
#: Windows whose seeds are computed at a time.
STEP = 1 << 16
#: Stands for a null id: after all others.
NO_ID = np.iinfo(np.int64).max

_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * _MIX[3]
    return h ^ h >> np.uint64(29)


def _string_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the `size` bytes (8 to 24) from every position on."""
    w = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view("<u8").ravel()
    n = len(data) - size + 1
    h = w[:n] * _MIX[0]
    for i, at in enumerate(sorted({size - 8, (size - 8) // 2} - {0})):
        h = h ^ w[at : at + n] * _MIX[1 + i]
    return _scrambled(h)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values."""
    n, m, span = len(h) - width + 1, h, 1
    while 2 * span <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[:n], m[width - span : width - span + n])


def _window_hash(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the `length` bytes at each of the given positions."""
    views = np.lib.stride_tricks.sliding_window_view(data, 8)
    h = np.zeros(len(at), np.uint64)
    for depth in [*range(0, length - 8, 8), length - 8]:
        h = _scrambled((h ^ np.ascontiguousarray(views[at + depth]).view("<u8").ravel()) * _MIX[0] + _MIX[1])
    return h


class Block:
    """Some documents' texts in a row, and the runs of their windows that share a seed: start, windows, seed, and the document they lie in."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, data: bytes, length: int):
        self.ids, self.sizes, self.data, self.length = ids, sizes, np.frombuffer(data, np.uint8), length
        self.ends = np.cumsum(sizes)
        seed_bytes = min(SEED_BYTES, length // 2)
        starts, seeds, n = [], [], len(data) - length + 1
        begin = self.ends - sizes
        fences = np.r_[begin, np.maximum(self.ends - length + 1, begin)]
        for lo in range(0, n, STEP):
            part = self.data[lo : min(lo + STEP + length - 1, len(data))]
            m = _least(_string_hashes(part, seed_bytes), length - seed_bytes + 1)
            turn = np.r_[True, m[1:] != m[:-1]]
            turn[fences[(fences >= lo) & (fences < lo + len(m))] - lo] = True
            at = np.flatnonzero(turn)
            at = np.concatenate([at, *(np.arange(a + length, b, length) for a, b in zip(at, np.r_[at[1:], len(m)]) if b - a > length)]) if len(m) and np.diff(np.r_[at, len(m)]).max() > length else at
            at.sort()
            starts.append(at + lo)
            seeds.append(m[at])
        self.start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.seed = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        self.count = np.diff(np.r_[self.start, max(n, 0)])
        self.doc = np.searchsorted(self.ends, self.start, "right")
        self._keep(self.start + length <= self.ends[self.doc] if len(self.start) else np.zeros(0, bool))

    def _keep(self, which: np.ndarray) -> None:
        self.start, self.seed, self.count, self.doc = self.start[which], self.seed[which], self.count[which], self.doc[which]

    def seeds(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct seeds as bucket << 32 | four bytes, in order, and for every run the place of its seed among them."""
        return np.unique((self.seed >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | self.seed & np.uint64(0xFFFFFFFF), return_inverse=True)

    def follow(self, buckets: int, shared: np.ndarray) -> None:
        """Keep the runs whose seed several documents have, by what is known of other blocks (0 none, 1 some, 2 very many) and by this block.

        Then number the different runs: `copy` is each run's number, `one` a run of each number, `first` the least id among them.
        """
        _, place = self.seeds(buckets)
        low, high = np.full(len(shared), NO_ID), np.full(len(shared), -1)
        np.minimum.at(low, place, self.doc)
        np.maximum.at(high, place, self.doc)
        common = shared[place] == 2
        kept = (shared[place] > 0) | (low < high)[place]
        self._keep(kept)
        common = common[kept]
        if common.any():
            single = np.repeat(np.flatnonzero(common), self.count[common])
            at = self.start[single] + np.arange(len(single)) - np.repeat(np.r_[0, np.cumsum(self.count[common])[:-1]], self.count[common])
            alone = _window_hash(self.data, at, self.length)
            parts = [(self.start, at), (self.count, np.ones_like(at)), (self.seed, alone), (self.doc, self.doc[single])]
            self.start, self.count, self.seed, self.doc = (np.concatenate([old[~common], more]) for old, more in parts)
        self.copy, self.one = distinct_runs(self.data, self.start, self.count, self.length)
        self.first = np.full(len(self.one), NO_ID)
        np.minimum.at(self.first, self.copy, self.ids[self.doc])

    def removed(self, first: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of removed bytes.

        `first` is the least id that has a run, by number; a later document loses all its windows, the holder of that id those marked in the bits of `windows`.
        """
        later = self.ids[self.doc] > first[self.copy]
        start, end = [self.start[later]], [self.start[later] + self.count[later] - 1 + self.length]
        some = np.flatnonzero(~later & (windows[self.copy] != 0))
        marks = windows[self.copy[some], None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)
        run, offset = np.nonzero(marks)
        start.append(self.start[some[run]] + offset)
        end.append(start[-1] + self.length)
        start, end = np.concatenate(start), np.concatenate(end)
        if not len(start):
            return start, end
        order = np.argsort(start, kind="stable")
        start, reach = start[order], np.maximum.accumulate(end[order])
        doc = np.searchsorted(self.ends, start, "right")
        cut = np.flatnonzero((start[1:] > reach[:-1]) | (doc[1:] != doc[:-1]))
        return start[np.r_[0, cut + 1]], reach[np.r_[cut, len(reach) - 1]]


def distinct_runs(data: np.ndarray, start: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of each run of windows among the different ones, and one run of each number. A run's first and last window cover all its bytes.

    Runs are ordered by a hash of those windows; neighbours count as equal only if their bytes are.
    """
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = start + count - 1
    h = _scrambled(_window_hash(data, start, length) * _MIX[2] ^ _window_hash(data, last, length) + count.astype(np.uint64))
    order = np.argsort(h, kind="stable")
    new = np.r_[True, (h[order][1:] != h[order][:-1]) | (count[order][1:] != count[order][:-1])]
    like = np.flatnonzero(~new)
    a, b = order[like - 1], order[like]
    views = np.lib.stride_tricks.sliding_window_view(data, length)
    for lo in range(0, len(a), STEP):
        x, y = a[lo : lo + STEP], b[lo : lo + STEP]
        differ = (views[start[x]] != views[start[y]]).any(axis=1) | (views[last[x]] != views[last[y]]).any(axis=1)
        new[like[lo : lo + STEP][differ]] = True
    number = np.empty(len(start), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The given stretches of bytes, one after the other."""
    return data[np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())] if len(start) else np.zeros(0, np.uint8)


def _zipped(x: np.ndarray | bytes) -> bytes:
    raw = x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unzipped(x: bytes) -> bytes:
    size = int.from_bytes(x[:8], "little")
    return pa.decompress(x[8:], size, codec="zstd", asbytes=True) if size else b""


def _rows(names: str, rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=names.split())


def _packed(block_bytes: int):
    """Cuts rows (id, text) into blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        ids: list[int] = []
        texts: list[bytes] = []
        held = 0

        def block() -> pa.RecordBatch:
            row = (number, held, _zipped(np.array(ids, np.int64)), _zipped(np.array([len(t) for t in texts], np.int64)), _zipped(b"".join(texts)))
            return _rows("block bytes ids sizes data", [row], [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids.append(NO_ID if i is None else i)
                texts.append(t.as_py() or b"")
                held += len(texts[-1])
                if held >= block_bytes:
                    yield block()
                    number, held = number + 1, 0
                    ids.clear()
                    texts.clear()
        if ids:
            yield block()

    return run


def _block(row: dict, length: int) -> Block:
    return Block(*(np.frombuffer(_unzipped(row[c]), np.int64) for c in ("ids", "sizes")), _unzipped(row["data"]), length)


def _by_bucket(batches: Iterator[pa.RecordBatch], answer) -> Iterator[pa.RecordBatch]:
    """Answers each bucket's rows, which follow each other: answer(rows) gives a batch."""
    held: list[dict] = []
    for b in batches:
        for row in b.to_pylist():
            if held and row["bucket"] != held[0]["bucket"]:
                yield answer(held)
                held = []
            held.append(row)
    if held:
        yield answer(held)


def _answers(blocks: DataFrame, kinds: list[DataFrame]) -> DataFrame:
    """Blocks with the answers of all buckets about them, as an array of (kind, bucket, payload)."""
    told = None
    for i, k in enumerate(kinds):
        one = k.select("block", F.struct(F.lit(i).alias("kind"), "bucket", "payload").alias("told"))
        told = one if told is None else told.union(one)
    return blocks.join(told.groupBy("block").agg(F.collect_list("told").alias("told")), "block", "left")


def _shared(blocks: DataFrame, buckets: int, length: int, common: int) -> DataFrame:
    """(block, bucket, payload): for a block's distinct seeds of a bucket, in order, whether no other block has it (0), some (1) or more than `common` (2)."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                seeds, _ = _block(row, length).seeds(buckets)
                of = (seeds >> np.uint64(32)).astype(np.int64)
                cut = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else of
                low = seeds.astype("<u4")
                out = [(int(of[x]), row["block"], low[x:y].tobytes()) for x, y in zip(cut, np.r_[cut[1:], len(of)])]
                yield _rows("bucket block seeds", out, [pa.int32(), pa.int64(), pa.binary()])

    def answer(rows: list[dict]) -> pa.RecordBatch:
        each = [np.frombuffer(r["seeds"], "<u4") for r in rows]
        _, place, times = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
        told = np.where(times > common, 2, np.where(times > 1, 1, 0)).astype(np.uint8)[place]
        ends = np.cumsum([len(e) for e in each])
        out = [(r["block"], r["bucket"], _zipped(told[e - len(s) : e])) for r, s, e in zip(rows, each, ends)]
        return _rows("block bucket payload", out, [pa.int64(), pa.int32(), pa.binary()])

    seeds = blocks.mapInArrow(report, "bucket int, block long, seeds binary")
    dealt = seeds.repartition(_tasks(buckets), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda batches: _by_bucket(batches, answer), "block long, bucket int, payload binary")


def _tasks(buckets: int) -> int:
    """Tasks for so many buckets: one each, until there are thousands."""
    return buckets if buckets <= 4096 else 4096 + (buckets - 4096) // 8


def _followed(row: dict, buckets: int, length: int) -> Block:
    block, told = _block(row, length), sorted((t["bucket"], t["payload"]) for t in row["told"] or () if t["kind"] == 0)
    block.follow(buckets, np.frombuffer(b"".join(_unzipped(p) for _, p in told), np.uint8))
    return block


def _runs_by_bucket(block: Block, buckets: int) -> list[tuple[int, np.ndarray]]:
    """Each bucket's different runs of a block, by number."""
    of = (block.seed[block.one] >> np.uint64(32)) % np.uint64(buckets)
    order = np.lexsort((block.start[block.one], of))
    cut = np.flatnonzero(np.r_[True, of[order][1:] != of[order][:-1]]) if len(order) else order
    return [(int(of[order[x]]), order[x:y]) for x, y in zip(cut, np.r_[cut[1:], len(order)])]


def _verdicts(blocks: DataFrame, shared: DataFrame, buckets: int, length: int) -> DataFrame:
    """(block, bucket, payload): for those of a block's different runs of a bucket that an earlier document has, wholly or in some windows, the place among
    them, the least id that has the run, and bits for the windows that even that id's document loses."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block, out = _followed(row, buckets, length), []
                for bucket, runs in _runs_by_bucket(block, buckets):
                    at = block.one[runs]
                    text = _gathered(block.data, block.start[at], block.count[at] - 1 + length)
                    out.append((bucket, row["block"], block.count[at].astype(np.uint8).tobytes(), _zipped(block.first[runs]), _zipped(text)))
                yield _rows("bucket block counts firsts data", out, [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])

    def answer(rows: list[dict]) -> pa.RecordBatch:
        counts = [np.frombuffer(r["counts"], np.uint8).astype(np.int64) for r in rows]
        count, local = np.concatenate(counts), np.concatenate([np.frombuffer(_unzipped(r["firsts"]), np.int64) for r in rows])
        data = np.frombuffer(b"".join(_unzipped(r["data"]) for r in rows), np.uint8)
        start = np.cumsum(count - 1 + length) - (count - 1 + length)
        number, one = distinct_runs(data, start, count, length)
        first = np.full(len(one), NO_ID)
        np.minimum.at(first, number, local)
        # all windows of different runs, in suffix order; the least id of each group of equal ones
        run = np.repeat(np.arange(len(one)), count[one])
        offset = np.arange(len(run)) - np.repeat(np.cumsum(count[one]) - count[one], count[one])
        order, new = sort_windows(data, start[one][run] + offset, length)
        earliest = np.minimum.reduceat(first[run[order]], np.flatnonzero(new))[np.cumsum(new) - 1]
        lost = earliest < first[run[order]]
        windows = np.zeros(len(one), np.uint64)
        np.bitwise_or.at(windows, run[order][lost], np.uint64(1) << offset[order][lost].astype(np.uint64))
        out, at = [], 0
        for r, c in zip(rows, counts):
            mine = slice(at, at + len(c))
            at += len(c)
            f, w = first[number[mine]], windows[number[mine]]
            told = np.flatnonzero((f < local[mine]) | (w != 0))
            if len(told):
                out.append((r["block"], r["bucket"], _zipped(told.astype("<u4").tobytes() + f[told].tobytes() + w[told].tobytes())))
        return _rows("block bucket payload", out, [pa.int64(), pa.int32(), pa.binary()])

    runs = _answers(blocks, [shared]).mapInArrow(report, "bucket int, block long, counts binary, firsts binary, data binary")
    dealt = runs.repartition(_tasks(buckets), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda batches: _by_bucket(batches, answer), "block long, bucket int, payload binary")


def _cut(buckets: int, length: int):
    """Blocks with their answers to documents: doc_id, n_bytes, starts and ends of the removed runs, and the bytes that are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block = _followed(row, buckets, length)
                first, windows = block.first.copy(), np.zeros(len(block.one), np.uint64)
                numbers = dict(_runs_by_bucket(block, buckets))
                for t in row["told"] or ():
                    if t["kind"] == 1:
                        raw = _unzipped(t["payload"])
                        n = len(raw) // 20
                        at = numbers[t["bucket"]][np.frombuffer(raw, "<u4", n)]
                        first[at], windows[at] = np.frombuffer(raw, np.int64, n, 4 * n), np.frombuffer(raw, np.uint64, n, 12 * n)
                start, end = block.removed(first, windows)
                doc = np.searchsorted(block.ends, start, "right")
                fences, text, out = np.searchsorted(doc, np.arange(len(block.ids) + 1)), block.data.tobytes(), []
                for i, (d, size, stop) in enumerate(zip(block.ids.tolist(), block.sizes.tolist(), block.ends.tolist())):
                    s, e = start[fences[i] : fences[i + 1]].tolist(), end[fences[i] : fences[i + 1]].tolist()
                    kept = b"".join(text[x:y] for x, y in zip([stop - size, *e], [*s, stop]))
                    out.append((None if d == NO_ID else d, size, [x - stop + size for x in s], [y - stop + size for y in e], kept))
                many = pa.list_(pa.int64())
                for lo in range(0, len(out), 1000):
                    yield _rows("doc_id n_bytes starts ends kept", out[lo : lo + 1000], [pa.int64(), pa.int64(), many, many, pa.binary()])

    return run


def without_repeats(
    docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, bucket: int = BUCKET, common: int = COMMON
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, the removed runs of bytes as arrays `starts` and `ends` (ends exclusive), and `kept`, the bytes that are left.

    A byte is removed when a window of `length` bytes that covers it also starts in a row with a smaller id. Null and empty texts and texts shorter than a
    window lose nothing. Rows with the same id remove nothing from each other, whether repeated or different; a row without an id comes after all that have
    one, and such rows remove nothing from each other. Ids are whole numbers. Text of any length is taken whole; a task holds one document at a time at least. `kept`
    may end or begin amidst a character, so it is binary. Other columns are ignored, whatever their names. `block`, `bucket` and `common` change
    the work's division only.
    """
    if not 16 <= length <= 64:
        raise ValueError("a window has 16 to 64 bytes")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    packed = staged(rows.mapInArrow(_packed(block), "block long, bytes long, ids binary, sizes binary, data binary"), "blocks")
    buckets = max(1, math.ceil((packed.agg(F.sum("bytes")).first()[0] or 0) / bucket))
    blocks = packed.drop("bytes")
    shared = staged(_shared(blocks, buckets, length, common), "shared-seeds")
    verdicts = _verdicts(blocks, shared, buckets, length)
    met = _answers(blocks, [shared, verdicts])
    return met.mapInArrow(_cut(buckets, length), "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary")


def n_removed() -> Column:
    """Number of removed bytes of a row of `without_repeats`."""
    return F.col("n_bytes") - F.octet_length("kept")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, and the hash of what is left."""
    return without_repeats(docs).select(
        "doc_id", "n_bytes", n_removed().cast("long").alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: The same result in DuckDB: all windows as hex text, and the least id of each.
ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunks AS (SELECT r, doc_id, k, substr(h, k * 2000 + 1, 2098) AS part FROM (SELECT r, doc_id, h, unnest(range(0, len(h) // 2000 + 1)) AS k FROM d)),
windows AS (SELECT r, doc_id, k * 1000 + i AS p, substr(part, 2 * i + 1, 100) AS w FROM (SELECT *, unnest(range(0, least(1000, len(part) // 2 - 49))) AS i FROM chunks WHERE len(part) >= 100)),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
hits AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM windows JOIN firsts USING (w) WHERE first < doc_id),
runs AS (SELECT r, p, sum(CASE WHEN p - before <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS g FROM hits),
spans AS (SELECT r, min(p) AS s, max(p) + 50 AS e FROM runs GROUP BY r, g),
gaps AS (SELECT r, s, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS b FROM spans),
heads AS (SELECT r, string_agg(substr(h, 2 * b + 1, 2 * (s - b)), '' ORDER BY s) AS kept FROM gaps JOIN d USING (r) GROUP BY r),
told AS (SELECT r, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last FROM spans GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN told USING (r) LEFT JOIN heads USING (r)
"""
