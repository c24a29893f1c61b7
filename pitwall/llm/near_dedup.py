"""SimHash near-duplicate detection over a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from pitwall.llm.columns import free_name, word_runs
from pitwall.llm.components import connected_components
from pitwall.llm.hamming import BITS, GrayIndex, block_tables, blocks_for, components, gray_rank, hex16, key_bits, packed, permuted, votes
from pitwall.sources.scratch import staged

#: Codes in a leaf of the index; a leaf is one row, and two leaves are compared in one step.
LEAF = 512
#: Codes below a top node on average, at most: the leading blocks get longer, and the bit orders more, as fingerprints become more.
NODE = 4096
#: Leaves of a branch, as a power of two.
BRANCH_BITS = 6
#: Pairs of leaves that a task searches, about a second of work.
PAIRS = 1000
#: Keys under which the values of one component meet its smallest id.
SALTS = 16
#: Seed of the shingle hash.
SEED = 42


def shingle_simhash(text: bytes, shingle: int) -> int:
    """Majority bits of the XXH64 of each `shingle` consecutive lower-cased words, repeats counted; a shorter text is one shingle, no word gives zero."""
    ones, n = np.zeros(BITS, np.int64), 0
    for words, first in word_runs(text.lower(), shingle - 1):
        if not words:
            continue
        count = len(words) - shingle + 1
        if count < 1:
            count = 1 if first else 0
        joined = words if shingle == 1 else map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), np.uint64, count)
        ones += votes(hashes)
        n += count
    return packed(ones * 2 > n)


def fingerprinted(docs: DataFrame, shingle: int = 5, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of every row, and its fingerprint as a long in the column fp. A null text counts as empty."""
    keep = keep if keep is not None else [c for c in docs.columns if c != text]
    fp, body = "fp", free_name(docs, "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1)
            codes = np.fromiter((shingle_simhash(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(codes)], names=[*b.schema.names[:-1], fp])

    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").cast("binary").alias(body))
    return rows.mapInArrow(run, rows.drop(body).withColumn(fp, F.lit(0).cast("long")).schema)


def _leaves(radius: int):
    """Cuts rows (table, node, code), sorted by table and Gray rank, into leaves of one top node, with the links found inside each leaf."""

    def leaf(table: int, node: int, codes: np.ndarray) -> tuple:
        a, b = GrayIndex(codes).search(codes, radius)
        label = components(len(codes), a, b) if len(a) > len(codes) else np.arange(len(codes))
        both, either = np.bitwise_and.reduce(codes), np.bitwise_or.reduce(codes)
        mask = ~(both ^ either)
        return table, node, int(codes.view(np.int64)[0]), int(mask.view(np.int64)), int((both & mask).view(np.int64)), codes.tobytes(), label.astype("<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: np.ndarray | None = None
        names = ["tab", "node", "leaf", "mask", "pattern", "codes", "labels"]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

        def cut(rows: np.ndarray, last: bool) -> tuple[list[tuple], np.ndarray]:
            if not len(rows):
                return [], rows
            starts = np.flatnonzero(np.r_[True, (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])])
            ends, out, done = np.r_[starts[1:], len(rows)], [], 0
            for s, e in zip(starts, ends):
                while s < e and (e - s >= LEAF or last or e < len(rows)):
                    stop = min(s + LEAF, e)
                    out.append(leaf(int(rows[s, 0]), int(rows[s, 1]), np.ascontiguousarray(rows[s:stop, 2]).view(np.uint64)))
                    s = done = stop
            return out, rows[done:]

        def packed_rows(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for b in batches:
            rows = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            out, rest = cut(rows if rest is None else np.concatenate([rest, rows]), False)
            if out:
                yield packed_rows(out)
        if rest is not None and len(rest):
            yield packed_rows(cut(rest, True)[0])

    return run


def _inside(order: list[tuple[int, int]], code: np.ndarray) -> np.ndarray:
    """Undo a bit order."""
    out, at = np.zeros_like(code), BITS
    for shift, width in order:
        at -= width
        out |= ((code >> np.uint64(at)) & np.uint64((1 << width) - 1)) << np.uint64(shift)
    return out


def linked(fps: DataFrame, radius: int, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between different values of the column fp: a spanning set of all pairs within `radius` bits.

    Every fingerprint is put into each bit order of `block_tables` (two values within the radius agree on the leading blocks of at least one).
    Rows are sorted by Gray rank over the whole cluster and cut into leaves of at most LEAF codes below their top node, which is the value of
    the leading blocks. Each leaf is one row with the bits its codes share. Inside a leaf the hierarchical index finds the links. Leaves of one
    top node are paired by what whole branches of them share, then by what they share, and dropped when those bits alone differ in more than `radius` bits;
    the pairs that are left are numbers, dealt out evenly over tasks whatever node they are of, and searched. Between two leaves one link per pair of already
    linked parts is kept.
    """
    blocks = blocks or blocks_for(fps.agg(F.approx_count_distinct("fp")).first()[0], radius, NODE)
    orders = block_tables(radius, blocks)
    uniq = fps.select("fp").distinct()
    # (table, permuted code) by Gray rank; the rank is unsigned, so its sign bit is turned
    coded = uniq.select(F.explode(F.array(*(F.struct(F.lit(i).alias("tab"), F.lit(BITS - key_bits(o, radius, blocks)).alias("low"), permuted(F.col("fp"), o).alias("code")) for i, o in enumerate(orders)))).alias("r")).select("r.*")
    ranked = coded.select("tab", F.expr("shiftrightunsigned(code, low)").alias("node"), "code", gray_rank(F.col("code")).bitwiseXOR(F.lit(-(1 << 63))).alias("rank"))
    sorted_rows = ranked.repartitionByRange("tab", "rank").sortWithinPartitions("tab", "rank").select("tab", "node", "code")
    cut = sorted_rows.mapInArrow(_leaves(radius), "tab int, node long, leaf long, mask long, pattern long, codes binary, labels binary")
    leaves = staged(cut.withColumn("seq", F.monotonically_increasing_id()), "leaves")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a_out, b_out = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for tab, codes, labels in zip(*(b.column(i).to_pylist() for i in range(3))):
                codes, labels = np.frombuffer(codes, np.uint64), np.frombuffer(labels, "<u2")
                other = np.flatnonzero(labels != np.arange(len(labels)))
                if len(other):
                    a_out.append(_inside(orders[tab], codes[other]))
                    b_out.append(_inside(orders[tab], codes[labels[other]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a_out, b_out)], names=["a", "b"])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a_out, b_out = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for tab, x, y, x_labels, y_labels in zip(*(b.column(i).to_pylist() for i in range(5))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                x_labels, y_labels = np.frombuffer(x_labels, "<u2"), np.frombuffer(y_labels, "<u2")
                i, j = GrayIndex(y).search(x, radius)
                _, one = np.unique(x_labels[i].astype(np.int64) << 16 | y_labels[j], return_index=True)
                a_out.append(_inside(orders[tab], x[i[one]]))
                b_out.append(_inside(orders[tab], y[j[one]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a_out, b_out)], names=["a", "b"])

    near = staged(_near_leaves(leaves, radius), "leaf-pairs")
    # a pair is a few numbers, but takes a millisecond: pairs are dealt out by their number, not by their bytes
    tasks = 1 + near.count() // PAIRS
    first = near.join(leaves.select(F.col("seq").alias("a"), "tab", "codes", "labels"), "a")
    pairs = first.join(leaves.select(F.col("seq").alias("b"), F.col("codes").alias("other"), F.col("labels").alias("other_labels")), "b")
    pairs = pairs.select("tab", "codes", "other", "labels", "other_labels", "a", "b").repartition(tasks, "a", "b").drop("a", "b")
    return leaves.select("tab", "codes", "labels").mapInArrow(within, "a long, b long").union(pairs.mapInArrow(across, "a long, b long"))


def _near_leaves(leaves: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b) of the numbers of different leaves of one top node whose shared bits differ in `radius` bits at most.

    The index has a level above the leaves: BRANCH leaves that follow each other in Gray order and the bits they all share. Branches of a top node are paired
    and dropped first, then the leaves of the pairs that are left; only numbers and masks meet here, no codes.
    """
    at = ["tab", "node", F.shiftright("seq", BRANCH_BITS).alias("branch")]
    flat = leaves.select(*at, "seq", "mask", "pattern")
    ones, zeros = F.expr("bit_and(pattern & mask)"), F.expr("bit_and(~pattern & mask)")
    branches = flat.groupBy("tab", "node", "branch").agg(ones.alias("ones"), zeros.alias("zeros")).select("tab", "node", "branch", F.col("ones").bitwiseOR(F.col("zeros")).alias("mask"), F.col("ones").alias("pattern"))

    def apart(p: str, q: str) -> Column:
        shared = F.col(f"{p}.mask").bitwiseAND(F.col(f"{q}.mask"))
        return F.bit_count(F.col(f"{p}.pattern").bitwiseXOR(F.col(f"{q}.pattern")).bitwiseAND(shared)) <= radius

    def same(p: str, q: str) -> Column:
        return (F.col(f"{p}.tab") == F.col(f"{q}.tab")) & (F.col(f"{p}.node") == F.col(f"{q}.node"))

    tops = branches.alias("p").join(branches.alias("q"), same("p", "q") & (F.col("p.branch") <= F.col("q.branch")) & apart("p", "q"))
    tops = tops.select("p.tab", "p.node", F.col("p.branch").alias("left"), F.col("q.branch").alias("right")).alias("t")
    half = tops.join(flat.alias("x"), same("t", "x") & (F.col("t.left") == F.col("x.branch"))).select("t.tab", "t.node", "right", F.col("x.seq").alias("seq"), F.col("x.mask").alias("mask"), F.col("x.pattern").alias("pattern")).alias("h")
    both = half.join(flat.alias("y"), same("h", "y") & (F.col("h.right") == F.col("y.branch")) & (F.col("h.seq") < F.col("y.seq")) & apart("h", "y"))
    a, b = F.col("h.seq"), F.col("y.seq")
    # which of the two comes first alternates, so no leaf is the first of all its pairs
    odd = (a + b) % 2 == 1
    return both.select(F.when(odd, a).otherwise(b).alias("a"), F.when(odd, b).otherwise(a).alias("b"))


def labelled(fps: DataFrame, radius: int) -> DataFrame:
    """For each value of fp in rows (doc_id, fp): root, a value that stands for its component, and component_id, the component's smallest doc_id.

    A value without links is its own component and meets nothing. The others meet their component's smallest id under SALTS keys for each component, so
    a component of very many values isn't one key.
    """
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(linked(fps, radius))
    joined = first.join(roots, first["fp"] == roots["node"], "left").select("fp", "first", "root").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int"))
    held = staged(joined, "rooted")
    several = held.filter("root is not null")
    # the least of each salt first, then of the root
    smallest = several.groupBy("root", "salt").agg(F.min("first").alias("first")).groupBy("root").agg(F.min("first").alias("component_id"))
    spread = smallest.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    linked_rows = several.join(spread, ["root", "salt"]).select("fp", "root", "component_id")
    return linked_rows.union(held.filter("root is null").select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id")))


def near_duplicates(docs: DataFrame, shingle: int = 5, radius: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, fp (long) and component_id, the smallest doc_id of the texts reachable over links of at most `radius` bits.

    A null or blank text has fingerprint zero and is linked like any other. A null doc_id keeps its row; it takes the smallest id of its component,
    null where all ids of the component are null. Repeated rows stay. Other columns are ignored, whatever their names.
    """
    fps = staged(fingerprinted(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shingle, keep=["doc_id"]), "fingerprints")
    return fps.join(labelled(fps, radius), "fp").select("doc_id", "fp", "component_id")


def one_per_component(docs: DataFrame, shingle: int = 5, radius: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of `docs`, unchanged: the one with the smallest id, of several rows with that id (or without any) the least.

    Only ids and fingerprints are grouped; texts move once, in the join with the kept ids. Rows with repeated or null ids, where there are any,
    are told apart by their fingerprint.
    """
    ids = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    fps = staged(fingerprinted(ids, shingle, keep=["doc_id"]), "fingerprints")
    label = staged(labelled(fps, radius), "labels")
    repeated = staged(fps.groupBy("doc_id").count().filter("count > 1 or doc_id is null").select(F.col("doc_id").alias("again")), "repeated")
    kept = label.filter("component_id is not null").select(F.col("component_id").alias("kept")).distinct()
    if repeated.isEmpty():
        return docs.join(kept, docs[doc_id] == kept["kept"], "left_semi")
    once = kept.join(repeated, F.col("kept") == F.col("again"), "left_anti")
    single = docs.join(once, docs[doc_id] == once["kept"], "left_semi")
    rest = docs.join(repeated, docs[doc_id].eqNullSafe(repeated["again"]), "left_semi")
    row = free_name(docs, "row")
    marked = fingerprinted(rest.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")), shingle)
    least = marked.join(label, "fp").filter("component_id is null or id = component_id").groupBy("root").agg(F.min(row).alias(row))
    return single.union(least.select(f"{row}.*"))


def digest(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """doc_id, the fingerprint as 16 hex digits, component_id."""
    return near_duplicates(docs, shingle, radius).select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
