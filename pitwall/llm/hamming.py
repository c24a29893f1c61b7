"""64-bit fingerprints: block permutations, Gray order, and a hierarchical index for Hamming search."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import Column, functions as F

BITS = 64


def block_tables(radius: int, blocks: int) -> list[list[tuple[int, int]]]:
    """Bit orders, each as (shift, width) segments from the top: one per choice of `blocks - radius` blocks moved to the front.

    Fingerprints that differ in at most `radius` bits agree on all of at least `blocks - radius` blocks, so some table has them under one key.
    """
    edges = [BITS - BITS * i // blocks for i in range(blocks + 1)]
    segments = [(edges[i + 1], edges[i] - edges[i + 1]) for i in range(blocks)]
    return [[segments[i] for i in front] + [s for i, s in enumerate(segments) if i not in front] for front in combinations(range(blocks), blocks - radius)]


def blocks_for(values: int, radius: int, per_key: int = 4) -> int:
    """Blocks such that a key of a block table is shared by about `per_key` of so many values, or by fewer: buckets stay small however many values there are."""
    want, blocks = math.log2(max(values, 2) / per_key), radius + 1
    while blocks < 2 * radius + 4 and BITS * (blocks - radius) // blocks < want:
        blocks += 1
    return blocks


def key_bits(order: list[tuple[int, int]], radius: int, blocks: int) -> int:
    return sum(width for _, width in order[: blocks - radius])


def permuted(fp: Column, order: list[tuple[int, int]]) -> Column:
    """The fingerprint with its bits in another order."""
    out, at = F.lit(0).cast("long"), BITS
    for shift, width in order:
        at -= width
        piece = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))
        out = out.bitwiseOR(F.shiftleft(piece, at))
    return out


def gray_rank(code: Column) -> Column:
    """Position of a code in the Gray sequence; codes of one rank prefix share their top bits."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), BITS // 4, "0")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def votes(hashes: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """For each of the 64 bits, top bit first, the number (or weight) of hashes that set it."""
    total = np.zeros(BITS, np.float64 if weights is not None else np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64) if weights is None else weights[i : i + (1 << 16)] @ bits
    return total


def packed(bits: np.ndarray) -> int:
    """64 booleans, top bit first, as an unsigned integer."""
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


class GrayIndex:
    """Hierarchical index over codes in Gray order.

    Every node stands for a run of neighbouring codes and holds the bits they share but their parent's run doesn't: a mask and a pattern.
    A search adds up the differences between a query and the shared bits on its way down and drops a whole run once they exceed the radius.
    """

    def __init__(self, codes: np.ndarray, fan_out: int = 8):
        """codes: uint64, sorted by Gray rank."""
        self.size, self.fan_out = len(codes), fan_out
        shared, pattern, levels = np.full(len(codes), ~np.uint64(0)), codes, []
        while True:
            levels.append((shared, pattern))
            if len(shared) <= fan_out:
                break
            cuts = np.arange(0, len(shared), fan_out)
            ones = np.bitwise_and.reduceat(pattern & shared, cuts)
            zeros = np.bitwise_and.reduceat(~pattern & shared, cuts)
            shared, pattern = ones | zeros, ones
        self.levels = []
        for depth in range(len(levels) - 1, -1, -1):
            mask, pattern = levels[depth]
            if depth < len(levels) - 1:
                mask = mask & ~levels[depth + 1][0][np.arange(len(mask)) // fan_out]
            self.levels.append((mask, pattern))

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs (query, code) of all codes within `radius` bits."""
        top = len(self.levels[0][0])
        q, node = np.repeat(np.arange(len(queries)), top), np.tile(np.arange(top), len(queries))
        gone = np.zeros(len(q), np.uint8)
        for depth, (mask, pattern) in enumerate(self.levels):
            if depth:
                at = (node[:, None] * self.fan_out + np.arange(self.fan_out)).ravel()
                q, gone = np.repeat(q, self.fan_out), np.repeat(gone, self.fan_out)
                real = at < len(mask)
                q, node, gone = q[real], at[real], gone[real]
            gone = gone + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            near = gone <= radius
            q, node, gone = q[near], node[near], gone[near]
        return q, node


def components(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of `size` items the smallest item it is linked to, by the links a-b."""
    label = np.arange(size)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (label == before).all():
            break
    return label
