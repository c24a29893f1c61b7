"""Edit-aware token counts: a segment tree of counts per document, re-encoded only where edits touch it."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pitwall.llm.columns import free_name
from pitwall.llm.encoder import Encoder, encoder, safe_cuts

#: Code points a leaf holds at least, the last one aside; a leaf ends at the next safe cut.
LEAF = 256


class CountTree:
    """Token counts of a text in a segment tree over runs of whole pre-tokens.

    Leaves are runs between safe cuts, where no token crosses. Each node holds the code points and tokens below it. An edit walks down by code points to
    the leaves it touches, with its boundary context: the leaf of the code point before it and of the one after. These leaves are joined, edited, cut
    anew and encoded; the subtrees on either side stay as they are, and only the sums on the way up are made anew.
    """

    def __init__(self, enc: Encoder, text: str):
        self.encoder, self.encoded = enc, 0
        self.root = self._joined(self._leaves(text))

    # a leaf is (code points, tokens, text), an inner node (code points, tokens, left, right)
    def _leaves(self, text: str) -> list[tuple]:
        runs, held, size = [], [], 0
        for part in safe_cuts(text):
            held.append(part)
            size += len(part)
            if size >= LEAF:
                runs.append("".join(held))
                held, size = [], 0
        if held or not runs:
            runs.append("".join(held))
        self.encoded += len(text)
        width = self.encoder.dtype.itemsize
        return [(len(r), len(self.encoder.encode(r)) // width, r) for r in runs]

    @staticmethod
    def _joined(nodes: list[tuple]) -> tuple:
        while len(nodes) > 1:
            pairs = [(a[0] + b[0], a[1] + b[1], a, b) for a, b in zip(nodes[::2], nodes[1::2])]
            nodes = pairs + nodes[len(pairs) * 2 :]
        return nodes[0]

    @property
    def length(self) -> int:
        return self.root[0]

    @property
    def tokens(self) -> int:
        return self.root[1]

    def text(self) -> str:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if len(node) == 3:
                out.append(node[2])
            else:
                stack += (node[3], node[2])
        return "".join(out)

    def edit(self, start: int, removed: int, inserted: str) -> None:
        """Replace `removed` code points from `start` on; places outside the text are moved to its ends."""
        start = min(max(start, 0), self.length)
        end = min(start + max(removed, 0), self.length)
        low, high = min(max(start - 1, 0), self.length - 1), end
        before, touched, after, stack = [], [], [], [(self.root, 0)]
        first = None
        while stack:
            node, at = stack.pop()
            if at > high:
                after.append(node)
            elif at + node[0] <= low:
                before.append(node)
            elif len(node) == 3:
                first = at if first is None else first
                touched.append(node[2])
            else:
                stack += ((node[3], at + node[2][0]), (node[2], at))
        body = "".join(touched)
        body = body[: start - first] + inserted + body[end - first :]
        parts = [self._joined(side) for side in (before, self._leaves(body) if body or not (before or after) else [], after) if side]
        self.root = self._joined(parts)


def counted(docs: DataFrame, vocabulary: str, edits: str = "edits", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of every row (all but text and edits by default), n_tokens, edited_tokens, edited_chars, and reencoded, the code points the edits
    made the tokenizer see again.

    `edits` is an array of structs (start, removed, inserted), applied in order, each to the outcome of the one before; places count code points. Null and
    empty arrays edit nothing, null edits are left out, a null start counts as 0 and null insertions as empty. A null text counts as empty. A row is
    handled by itself, so nothing is shuffled, and a task holds one document's tree at a time.
    """
    keep = keep if keep is not None else [c for c in docs.columns if c not in (text, edits)]
    body, changes = free_name(docs, "body"), free_name(docs, "changes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            texts, lists = b.column(b.num_columns - 2), b.column(b.num_columns - 1)
            out = []
            for t, e in zip(texts, lists):
                tree = CountTree(enc, t.as_py() or "")
                n, tree.encoded = tree.tokens, 0
                for change in e.as_py() or []:
                    if change is not None:
                        tree.edit(change["start"] or 0, change["removed"] or 0, change["inserted"] or "")
                out.append((n, tree.tokens, tree.length, tree.encoded))
            columns = [pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], [], []))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], *columns], names=[*b.schema.names[:-2], "n_tokens", "edited_tokens", "edited_chars", "reencoded"])

    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias(body), F.col(f"`{edits}`").cast("array<struct<start:bigint,removed:bigint,inserted:string>>").alias(changes))
    zero = F.lit(0).cast("long")
    return rows.mapInArrow(run, rows.drop(body, changes).withColumns({c: zero for c in ("n_tokens", "edited_tokens", "edited_chars", "reencoded")}).schema)


def digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, edited_tokens, edited_chars, reencoded for four edits of every document: 20 code points a third of the way in give way to the text's
    first 12, a word and a blank come in front, a line end comes last, and the code point in the middle goes."""
    n = F.length("text")
    change = [F.struct(F.expr("length(text) div 3").alias("start"), F.lit(20).alias("removed"), F.substring("text", 1, 12).alias("inserted")),
              F.struct(F.lit(0).alias("start"), F.lit(0).alias("removed"), F.lit("new ").alias("inserted")), F.struct((n + F.lit(1 << 30)).alias("start"), F.lit(0).alias("removed"), F.lit("\n").alias("inserted")),
              F.struct(F.expr("length(text) div 2").alias("start"), F.lit(1).alias("removed"), F.lit("").alias("inserted"))]
    return counted(docs.select("doc_id", "text").withColumn("edits", F.array(*change)), vocabulary)
