"""Merkle manifest of a dataset: one tree per group of rows, their roots under one root, nodes stored in van Emde Boas order.

A tree is cut into aligned blocks of four levels below their root (4,096 leaves). A block is one row; its nodes lie in one array, whose order splits the
block's levels at half their number, the upper part first, then each lower part, and so on inside the parts. Where a node lies follows from its depth and
number alone (`address`), for building as for finding siblings. Block roots are the leaves of the next round of blocks, until one is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pitwall.llm.columns import ascii_lower, crc_bucket
from pitwall.sources.scratch import staged

#: Children of a node.
FAN_BITS = 3
FAN = 1 << FAN_BITS
#: Levels of a block below its root.
HEIGHT = 4
DIGEST = 32
#: What a leaf of the query's manifest covers, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def nodes_in(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (FAN**levels - 1) // (FAN - 1)


def address(levels: int, depth: int, index: np.ndarray | int):
    """Where the nodes `index` of one depth (0 is the root) lie in the van Emde Boas order of a full tree of `levels` levels."""
    if levels == 1:
        return index * 0
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, index)
    below = FAN ** (depth - upper)
    return nodes_in(upper) + index // below * nodes_in(levels - upper) + address(levels - upper, depth - upper, index % below)


@cache
def _addresses(height: int) -> list[np.ndarray]:
    return [address(height + 1, depth, np.arange(FAN**depth)) for depth in range(height + 1)]


def _counts(height: int, leaves: int) -> list[int]:
    """Nodes at each depth of a block with so many leaves: a run of siblings may be short, and a single node has a parent too."""
    return [-(-leaves // FAN ** (height - depth)) for depth in range(height + 1)]


def build_block(height: int, leaves: list[bytes]) -> bytes:
    """The nodes of a block, 32 bytes each; nodes that aren't there are zero. A parent is the hash of its children's digests as hex text."""
    where, counts = _addresses(height), _counts(height, len(leaves))
    nodes = np.zeros((nodes_in(height + 1), DIGEST), np.uint8)
    nodes[where[height][: len(leaves)]] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, DIGEST)
    for depth in range(height - 1, -1, -1):
        below = nodes[where[depth + 1][: counts[depth + 1]]].tobytes().hex().encode()
        run = FAN * DIGEST * 2
        made = b"".join(hashlib.sha256(below[i * run : (i + 1) * run]).digest() for i in range(counts[depth]))
        nodes[where[depth][: counts[depth]]] = np.frombuffer(made, np.uint8).reshape(-1, DIGEST)
    return nodes.tobytes()


def block_paths(height: int, leaves: int, nodes: bytes, above: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """For every leaf of a block the digests left and right of it in its run, level by level up to the root of all; `above` is the path of the block's root."""
    where, counts = _addresses(height), _counts(height, leaves)
    table = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    paths, one = [above], DIGEST * 2
    for depth in range(1, height + 1):
        here = table[where[depth][: counts[depth]]].tobytes().hex()
        nxt = []
        for i in range(counts[depth]):
            low, high = i // FAN * FAN * one, min((i // FAN + 1) * FAN, counts[depth]) * one
            nxt.append([(here[low : i * one], here[(i + 1) * one : high]), *paths[i // FAN]])
        paths = nxt
    return paths


def folded(leaf: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its path give."""
    for left, right in path:
        leaf = hashlib.sha256(f"{left}{leaf}{right}".encode()).hexdigest()
    return leaf


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hash of the given values, each as its length in bytes, a colon, and its text; a dash for null."""

    def told(c: Column) -> Column:
        c = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))

    return F.sha2(F.concat(*map(told, fields)).cast("binary"), 256)


def ranked(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The rows, written in order, with their place in it as a long in the column `at`. Equal rows get places in any order.

    Rows are range-sorted over the cluster; a place is the row's number in its task plus the rows of all tasks before, one number each. `rows` must be a written table.
    """
    tie = F.monotonically_increasing_id()
    keyed = rows.withColumn("tie", tie)
    sorted_rows = keyed.repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie").drop("tie").withColumn("id", F.monotonically_increasing_id())
    written = staged(sorted_rows, name).withColumn("task", F.shiftright("id", 33))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = written.groupBy("task").agg(F.count("*").alias("n")).select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return written.join(tasks, "task").withColumn("at", F.col("base") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))).drop("task", "id", "base")


def tree_height(n: Column) -> Column:
    """Levels below the root of a tree of n leaves: the octal digits of n - 1."""
    return F.when(n <= 1, 0).otherwise(F.length(F.conv((n - 1).cast("string"), 10, FAN))).cast("int")


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Builds blocks from their sorted members; the root's digest is a column of its own."""
    for b in batches:
        built = []
        for height, members in zip(b.column("height").to_pylist(), b.column("members")):
            digests = members.values.field("digest").to_pylist()
            built.append(build_block(min(height, HEIGHT), [bytes.fromhex(d) for d in digests]))
        at = [nodes[:DIGEST].hex() for nodes in built]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(built, pa.binary()), pa.array(at, pa.string())], names=[*b.schema.names, "nodes", "digest"])


def forest(leaves: DataFrame, rounds: int, keep: Sequence[str] = (), name: str = "blocks") -> list[DataFrame]:
    """Blocks of all trees, a written table for each round, leaves first: tree, block, height (levels left below the tree's root), members, nodes, digest.

    `leaves` has the columns tree, place (0 on, in order), height (of the tree), digest (hex) and those to `keep` with the members.
    """
    out, nodes, carried = [], leaves, list(keep)
    for _ in range(rounds):
        slot = F.col("place").bitwiseAND(F.lit(FAN**HEIGHT - 1)).cast("int").alias("slot")
        grouped = nodes.withColumn("block", F.shiftright("place", FAN_BITS * HEIGHT)).groupBy("tree", "block").agg(
            F.first("height").alias("height"), F.array_sort(F.collect_list(F.struct(slot, "digest", *carried))).alias("members"))
        schema = grouped.withColumns({"nodes": F.lit(b""), "digest": F.lit("")}).schema
        blocks = staged(grouped.mapInArrow(_block_rows, schema), name)
        out.append(blocks)
        nodes = blocks.filter(F.col("height") > HEIGHT).select("tree", F.col("block").alias("place"), (F.col("height") - HEIGHT).alias("height"), "digest")
        carried = []
    return out


_PATH = "array<struct<left:string,right:string>>"


def _paths_of(batch: pa.RecordBatch) -> Iterator[tuple[dict, list[dict], list[list[tuple[str, str]]]]]:
    """Per block of a batch: its row without members, its members, and their paths."""
    plain = [n for n in batch.schema.names if n not in ("members", "nodes", "path")]
    for i in range(batch.num_rows):
        row = {n: batch.column(n)[i].as_py() for n in plain}
        members = batch.column("members")[i].as_py()
        above = [(s["left"], s["right"]) for s in batch.column("path")[i].as_py()]
        yield row, members, block_paths(min(row["height"], HEIGHT), len(members), batch.column("nodes")[i].as_py(), above)


def _step_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [(row["tree"], (row["block"] << FAN_BITS * HEIGHT) + m["slot"], [{"left": x, "right": y} for x, y in p]) for row, members, paths in _paths_of(b) for m, p in zip(members, paths)]
        path = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, [pa.int64(), pa.int64(), path])], names=["tree", "block", "path"])


def with_paths(blocks: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """The first round's blocks with the column path: the way from their root to the root of all, level by level.

    `above` has tree and the path of its root; without it the trees' roots are where all paths end.
    """
    for i in range(len(blocks) - 1, -1, -1):
        # a block with at most HEIGHT levels left holds its tree's root; the others hang below a block of the next round
        tops = blocks[i].filter(F.col("height") <= HEIGHT)
        tops = tops.join(above, "tree") if above is not None else tops.withColumn("path", F.array().cast(_PATH))
        met = tops if i == len(blocks) - 1 else tops.unionByName(blocks[i].filter(F.col("height") > HEIGHT).join(below, ["tree", "block"]))
        if i:
            below = met.mapInArrow(_step_down, f"tree long, block long, path {_PATH}")
    return met


@dataclass
class Manifest:
    """Written blocks of the trees, those of the tree over their roots, and the trees: tree, group, subroot, height."""

    blocks: list[DataFrame]
    top: list[DataFrame]
    trees: DataFrame
    root: str | None

    def with_paths(self) -> DataFrame:
        """First-round blocks with the path of their root up to the root of all, and the subroot of their tree."""
        top = with_paths(self.top, None).mapInArrow(_step_down, f"tree long, block long, path {_PATH}")
        above = top.select(F.col("block").alias("tree"), "path")
        return with_paths(self.blocks, above).join(self.trees.select("tree", "subroot"), "tree")

    def proofs(self) -> DataFrame:
        """Per row: the kept columns, leaf, subroot, root, and its path: left and right siblings of each level, from the leaf up."""
        kept = [f for f in self.blocks[0].schema["members"].dataType.elementType.fields if f.name not in ("slot", "digest")]
        root = self.root

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            path = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
            for b in batches:
                kept_types = [b.schema.field("members").type.value_type.field(f.name).type for f in kept]
                for row, members, paths in _paths_of(b):
                    columns = [pa.array([m[f.name] for m in members], t) for f, t in zip(kept, kept_types)]
                    columns += [pa.array([m["digest"] for m in members]), pa.array([row["subroot"]] * len(members)), pa.array([root] * len(members))]
                    columns.append(pa.array([[{"left": x, "right": y} for x, y in p] for p in paths], path))
                    yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in kept), "leaf", "subroot", "root", "path"])

        shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
        return self.with_paths().mapInArrow(run, f"{shape}, leaf string, subroot string, root string, path {_PATH}")


def build(leaves: DataFrame, group: str, order: Sequence[str], digest: str, keep: Sequence[str]) -> Manifest:
    """Manifest of written rows that hold their leaf digest: a tree per value of `group`, leaves ascending by `order`, null first, ties by digest.

    Groups ascend bytewise as text, null first. An empty table has no tree and no root.
    """
    names = list(dict.fromkeys([group, *order, digest, *keep]))
    at = ranked(leaves.select(*names), [F.col(c).asc_nulls_first() for c in (group, *order, digest)], "leaves")
    groups = staged(at.groupBy(F.col(group).alias("group")).agg(F.min("at").alias("first"), F.count("*").alias("n")), "groups")
    trees = staged(ranked(groups, [F.col("group").asc_nulls_first()], "trees").select("group", "first", "n", F.col("at").alias("tree"), tree_height(F.col("n")).alias("height")), "trees")
    highest, n_trees = trees.agg(F.max("height"), F.count("*")).first()
    placed = at.join(trees, at[group].eqNullSafe(trees["group"])).select("tree", (F.col("at") - F.col("first")).alias("place"), "height", F.col(digest).alias("digest"), *[F.col(c) for c in keep])
    blocks = forest(placed, _rounds(highest or 0), keep)
    subroots = blocks[-1].filter(F.lit(False)).select("tree", "digest")
    for b in blocks:
        subroots = subroots.union(b.filter(F.col("height") <= HEIGHT).select("tree", "digest"))
    trees = staged(trees.join(subroots, "tree").select("tree", "group", F.col("digest").alias("subroot"), "n", "height"), "subroots")
    over = trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), tree_height(F.lit(n_trees)).alias("height"), F.col("subroot").alias("digest"))
    top = forest(over, _rounds(len(oct(n_trees - 1)) - 2 if n_trees > 1 else 0), name="top")
    found = top[-1].select("digest").first()
    return Manifest(blocks, top, trees, found["digest"] if found else None)


def _rounds(height: int) -> int:
    return max(1, -(-height // HEIGHT))


def digest(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, leaf, subroot, root, proof_sha256 (hash of all siblings up to the root), folded_root (from the leaf, tampered where 3 divides
    the id's crc32), and whether that is the root.

    Rows with a null or repeated id are leaves like any other, null first, ties by digest; equal rows share their results' leaf but not their place. A row
    without an id is not tampered with, as no crc32 is divisible. An empty table gives no row. Other columns are ignored, whatever their names.
    """
    changed = F.when(crc_bucket(F.col("doc_id"), 3) == 0, leaf_digest([ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]))
    rows = docs.select("doc_id", "lang", leaf_digest([F.col(c) for c in FIELDS]).alias("leaf"), changed.alias("offered"))
    manifest = build(staged(rows, "leaf-digests"), "lang", ["doc_id"], "leaf", ["doc_id", "offered"])
    root = manifest.root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        for b in batches:
            for row, members, paths in _paths_of(b):
                out = []
                for m, path in zip(members, paths):
                    proof = hashlib.sha256("".join(s for pair in path for s in pair).encode()).hexdigest()
                    end = folded(m["offered"] or m["digest"], path)
                    out.append((m["doc_id"], m["digest"], row["subroot"], root, proof, end, end == root))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    met = manifest.with_paths()
    return met.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
