"""Deep-shallow sorting of byte windows: multikey quicksort to a shallow depth, then blind tries for what shares a long prefix."""

from __future__ import annotations

import numpy as np

#: Bytes up to which every group of windows with a common prefix is split by multikey quicksort.
SHALLOW = 24
#: Members of a group that goes to a blind trie beyond that depth; larger groups are split further by multikey quicksort first.
BLIND = 16


def _word(views: np.ndarray, at: np.ndarray, depth: int, length: int) -> np.ndarray:
    """Eight bytes from `depth` on of the windows at `at`, as numbers in byte order; bytes beyond the window's length are zero."""
    out = np.ascontiguousarray(views[at + depth]).view(">u8").ravel().astype(np.uint64)
    over = depth + 8 - length
    return out if over <= 0 else out >> np.uint64(8 * over) << np.uint64(8 * over)


def _first_difference(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of the first bit in which the rows of two word matrices differ; -1 for equal rows."""
    apart = x ^ y
    word = (apart != 0).argmax(axis=1)
    v = apart[np.arange(len(apart)), word]
    same = v == 0
    for s in (1, 2, 4, 8, 16, 32):
        v = v | v >> np.uint64(s)
    return np.where(same, -1, word * 64 + 64 - np.bitwise_count(v).astype(np.int64))


def blind_tries(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rank of every member inside its group; equal members share a rank.

    Row i of `words` is a member's bytes as big-endian numbers, group g owns the rows from start[g] on, `size[g]` of them. A trie is over bits: a node
    holds only the bit it branches on. To insert a member, all tries of a round go down by these bits alone to one leaf, compare the member with this leaf,
    and put a node at the first bit in which they differ. All groups take one member a round, so the rounds are as many as the largest group has members.
    """
    groups, most = len(start), int(size.max(initial=0))
    bit, child = np.zeros((groups, most), np.int64), np.zeros((groups, most, 2), np.int64)
    root, nodes, leaf_of = np.full(groups, -1), np.zeros(groups, np.int64), np.zeros((groups, most), np.int64)

    def side(g: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
        return (x[np.arange(len(x)), b >> 6] >> (63 - (b & 63)).astype(np.uint64) & np.uint64(1)).astype(np.int64)

    for t in range(1, most):
        g = np.flatnonzero(size > t)
        x, at = words[start[g] + t], root[g].copy()
        while len(down := np.flatnonzero(at >= 0)):
            at[down] = child[g[down], at[down], side(g[down], bit[g[down], at[down]], x[down])]
        leaf = -1 - at
        cut = _first_difference(x, words[start[g] + leaf])
        leaf_of[g, t] = np.where(cut < 0, leaf, t)
        new = cut >= 0
        g, x, cut = g[new], x[new], cut[new]
        at, above, turn = root[g].copy(), np.full(len(g), -1), np.zeros(len(g), np.int64)
        while len(down := np.flatnonzero((at >= 0) & (bit[g, np.maximum(at, 0)] < cut))):
            above[down] = at[down]
            turn[down] = side(g[down], bit[g[down], at[down]], x[down])
            at[down] = child[g[down], at[down], turn[down]]
        node = nodes[g]
        nodes[g] += 1
        bit[g, node] = cut
        here = side(g, cut, x)
        child[g, node, here], child[g, node, 1 - here] = -1 - t, at
        top = above < 0
        root[g[top]] = node[top]
        child[g[~top], above[~top], turn[~top]] = node[~top]

    rank, stack, depth, done = np.zeros((groups, most), np.int64), np.zeros((groups, most + 1), np.int64), np.ones(groups, np.int64), np.zeros(groups, np.int64)
    stack[:, 0] = root
    while len(g := np.flatnonzero(depth)):
        depth[g] -= 1
        at = stack[g, depth[g]]
        leaf = at < 0
        rank[g[leaf], -1 - at[leaf]] = done[g[leaf]]
        done[g[leaf]] += 1
        g, at = g[~leaf], at[~leaf]
        for way in (1, 0):
            stack[g, depth[g]] = child[g, at, way]
            depth[g] += 1
    member = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    group = np.repeat(np.arange(groups), size)
    return rank[group, leaf_of[group, member]]


def sort_windows(data: np.ndarray, at: np.ndarray, length: int, shallow: int = SHALLOW, blind: int = BLIND) -> tuple[np.ndarray, np.ndarray]:
    """The windows of `length` bytes that start at the positions `at` of `data` (uint8), in byte order.

    Returns the order, as indexes into `at`, and for each place whether its window differs from the one before. A multikey quicksort takes eight bytes a
    step: the windows of every open group, those equal so far, are ordered by their next eight bytes and fall into smaller groups. Beyond `shallow` bytes
    groups of at most `blind` members are put in order by blind tries over the rest.
    """
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    views = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    first = _word(views, at, 0, length)
    order = np.argsort(first)
    first = first[order]
    new = np.r_[True, first[1:] != first[:-1]]
    depth, closed = 8, np.zeros(len(at), bool)
    while depth < length:
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(at)])
        open_ = (sizes > 1) & ~closed[starts]
        small = open_ & (sizes <= blind) if depth >= shallow else np.zeros(len(starts), bool)
        if small.any():
            s, n = starts[small], sizes[small]
            place = np.repeat(s - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            rest = np.stack([_word(views, at[order[place]], d, length) for d in range(depth, length, 8)], axis=1)
            rank = blind_tries(rest, np.cumsum(n) - n, n)
            group = np.repeat(np.arange(len(s)), n)
            by = np.lexsort((rank, group))
            order[place] = order[place[by]]
            new[place] = np.r_[True, (rank[by][1:] != rank[by][:-1]) | (group[1:] != group[:-1])]
            closed[place] = True
        large = open_ & ~small
        if large.any():
            s, n = starts[large], sizes[large]
            place = np.repeat(s - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            group, word = np.repeat(np.arange(len(s)), n), _word(views, at[order[place]], depth, length)
            by = np.lexsort((word, group))
            order[place] = order[place[by]]
            word = word[by]
            new[place] = np.r_[True, (word[1:] != word[:-1]) | (group[1:] != group[:-1])]
        elif not small.any():
            break
        depth += 8
    return order, new
