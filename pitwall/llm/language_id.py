"""Language identification by nearest centroid over TF-IDF vectors of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from pitwall.llm.columns import crc_bucket, free_name

UNKNOWN = "und"
#: Code points of a text that are counted at a time.
RUN = 1 << 18
#: Languages up to which one row for each is broadcast.
MOST_BROADCAST = 10_000
_SPACE = 32
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_LETTERS: list[np.ndarray] = []


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit."""

    #: Labelled rows at most, shared evenly by the languages (one of each at least); those with the least hash of their id.
    rows: int = 4000
    #: Centroids per language.
    centroids: int = 4
    #: Hashed dimensions of a vector, a power of two up to 65,536.
    dimensions: int = 4096
    #: A text whose cosine to its language is below this quantile of the training texts' own is rejected.
    reject_quantile: float = 0.005
    seed: int = 5


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def ngram_counts(text: str, dimensions: int) -> np.ndarray | None:
    """Hashed counts of the one- to three-letter runs of a lower-cased text, where all that isn't a letter counts as one space; None without a letter."""
    total, tail, any_letter = np.zeros(dimensions, np.int64), np.array([_SPACE], np.uint64), False
    shift = np.uint64(64 - dimensions.bit_length() + 1)
    for i in range(0, len(text), RUN):
        codes = np.frombuffer(text[i : i + RUN].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(_letters()[codes], codes, _SPACE)
        any_letter = any_letter or bool((codes != _SPACE).any())
        c = np.concatenate([tail, codes.astype(np.uint64)])
        if i + RUN >= len(text):
            c = np.append(c, np.uint64(_SPACE))
        first = len(tail)
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != _SPACE) | (c[:-1] != _SPACE)
        first -= int((~keep[:first]).sum())
        c = c[keep]
        grams = c * _MIX[0]
        # every run that ends at a new code point; the tail holds what the last run of code points left
        for n in range(3):
            if n:
                grams = grams[:-1] * _MIX[n] + c[n:] * _MIX[0]
            new = grams[max(first - n, 0):]
            if n == 0:
                new = new[c[first:] != _SPACE]
            total += np.bincount((new * _MIX[1] ^ (new >> np.uint64(29)) * _MIX[2]) >> shift, minlength=dimensions)
        tail = c[-2:]
    return total if any_letter else None


class Centroids:
    """The fitted model: small arrays that go to the tasks with the function."""

    def __init__(self, languages: list[str], owner: np.ndarray, centres: np.ndarray, idf: np.ndarray, least: np.ndarray):
        """owner: language index of each centroid. least: cosine below which a text of a language is rejected."""
        self.languages, self.owner, self.centres, self.idf, self.least = languages, owner, centres, idf, least

    def vectors(self, counts: list[np.ndarray]) -> np.ndarray:
        return _unit(np.log1p(np.array(counts, np.float32)) * self.idf)

    def nearest(self, counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Language index and cosine of the nearest centroid; of equals the first."""
        cosine = self.vectors(counts) @ self.centres.T
        best = cosine.argmax(axis=1)
        return self.owner[best], np.clip(cosine[np.arange(len(best)), best], 0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _clustered(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means: unit centres of at most `k` clusters of unit rows, started from the row nearest the mean and then the farthest ones."""
    picks = [int((x @ x.mean(axis=0)).argmax())]
    while len(picks) < min(k, len(x)):
        far = (x @ x[picks].T).max(axis=1)
        if far.min() > 1 - 1e-6:
            break
        picks.append(int(far.argmin()))
    centres = x[picks]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        centres = _unit(np.array([x[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))]))
    return centres


def fit(labelled: DataFrame, training: Training = Training(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Centroids | None:
    """Fit on rows with a text and a language; others are left out. None where no row is left.

    Rows are chosen by id, tasks turn their texts into counts, and the bounded sample's sparse counts come to the driver, where they are clustered.
    """
    rows = labelled.select(F.col(f"`{lang}`").alias("lang"), F.xxhash64(F.lit(training.seed), F.col(f"`{doc_id}`").cast("string"), F.col(f"`{lang}`")).alias("h"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter("lang is not null and text is not null")
    # how many rows of a language there are tells up to which hash twice its quota lies, so no language's ids are ever gathered whole
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    languages = sizes.count()
    if not languages:
        return None
    quota = max(1, training.rows // languages)
    share = F.least(F.lit(2.0 * quota + 50) / F.col("n"), F.lit(1.0))
    sizes = sizes.select("lang", (share * float(1 << 64) - float(1 << 63)).alias("upto"))
    # small by count: one row per language; without the hint, rows would be dealt out by language first
    small = F.broadcast if languages <= MOST_BROADCAST else lambda df: df
    few = rows.select("lang", "h").join(small(sizes), "lang").filter(F.col("h").cast("double") <= F.col("upto")).select("lang", "h").distinct()
    bound = few.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("n") <= quota).groupBy("lang").agg(F.max("h").alias("last"))
    sample = rows.join(small(bound), "lang").filter("h <= last").groupBy("lang", "h").agg(F.min("text").alias("text"))
    dimensions = training.dimensions

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {"lang": [], "h": [], "at": [], "n": []}
            for lang, h, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                counts = ngram_counts(t, dimensions)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    for k, v in zip(out, (lang, h, at.astype("<u2").tobytes(), counts[at].astype("<u4").tobytes())):
                        out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out["lang"], pa.string()), pa.array(out["h"], pa.int64()), pa.array(out["at"], pa.binary()), pa.array(out["n"], pa.binary())], names=list(out))

    found = sorted(sample.mapInArrow(count, "lang string, h long, at binary, n binary").collect(), key=lambda r: (r["lang"], r["h"]))
    if not found:
        return None
    counts = np.zeros((len(found), dimensions), np.float32)
    for i, r in enumerate(found):
        counts[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<u4")
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x, names = _unit(np.log1p(counts) * idf), sorted({r["lang"] for r in found})
    centres, owner, least = [], [], []
    for i, name in enumerate(names):
        mine = x[[r["lang"] == name for r in found]]
        centres.append(_clustered(mine, training.centroids))
        owner += [i] * len(centres[-1])
        least.append(np.quantile((mine @ centres[-1].T).max(axis=1), training.reject_quantile))
    return Centroids(names, np.array(owner), np.concatenate(centres).astype(np.float32), idf, np.array(least))


def identified(docs: DataFrame, model: Centroids | None, training: Training = Training(), text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of every row (all but the text by default), lang_pred, score and rejected.

    lang_pred is the language of the nearest centroid, whatever its distance, and score its cosine. `rejected` marks texts that are farther from it
    than nearly all training texts of that language are from theirs: they may be in no learned language. Null texts, texts without a letter, and all
    texts without a model are `und`, with score zero, rejected.
    """
    keep = keep if keep is not None else [c for c in docs.columns if c != text]
    body, dimensions = free_name(docs, "body"), training.dimensions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n = b.column(b.num_columns - 1), b.num_rows
            lang, score, rejected = np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
            for i in range(0, n, 256):
                counts = [(j, c) for j in range(i, min(i + 256, n)) if model and (t := texts[j].as_py()) and (c := ngram_counts(t, dimensions)) is not None]
                if counts:
                    at, found = [j for j, _ in counts], model.nearest([c for _, c in counts])
                    lang[at] = np.array(model.languages, object)[found[0]]
                    score[at], rejected[at] = found[1], found[1] < model.least[found[0]]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=[*b.schema.names[:-1], "lang_pred", "score", "rejected"])

    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias(body))
    return rows.mapInArrow(run, rows.drop(body).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "rejected": F.lit(True)}).schema)


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id's text leaves two by four; a null id isn't held out."""
    return F.coalesce(crc_bucket(F.col(f"`{doc_id}`"), 4) == 2, F.lit(False))


def digest(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: learned from the rows that aren't held out, told for all."""
    model = fit(docs.filter(~held_out()).select("doc_id", "text", "lang"), training)
    return identified(docs.select("doc_id", "text"), model, training).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
