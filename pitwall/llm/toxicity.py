"""Toxicity scores: gradient-boosted trees over dense features of whole texts, calibrated by isotonic regression."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pitwall.llm.columns import crc_bucket, free_name
from pitwall.sources.scratch import staged

# fixed word lists
#: Abuse aimed at a person.
INSULTS = frozenset("idiot idiots moron morons loser losers stupid clown clowns dumb fool imbecile cretin dimwit halfwit jackass dumbass asshole bastard bitch".split())
#: Words that degrade.
CONTEMPT = frozenset("trash scum worthless pathetic disgusting garbage filth filthy vermin vile repulsive subhuman useless ugly freak pig swine parasite".split())
#: Threats and profanity; words that other languages use innocently, as German does `die`, are left out.
HOSTILE = frozenset("kill hate fuck fucking fucked shit crap damn rape murder".split())
SECOND_PERSON = frozenset("you your yours yourself youre u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tus vuestro".split())

LEXICONS = (INSULTS, CONTEMPT, HOSTILE)
KNOWN = INSULTS | CONTEMPT | HOSTILE
#: Stand-ins for letters.
LOOKALIKES = str.maketrans("013457@$!|+€", "oieastasiite")
#: Letters of a learned stem, at least and at most.
STEM = (4, 8)
#: Tokens between an abusive word and a second person that still count as near.
NEAR = 5

_WORD = re.compile(r"[^\W_]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_DISGUISE = re.compile(r"[013457@$!|+€]|(\w)\1\1")
_SPACED = re.compile(r"(?<!\w)\w(?:[ .\-_*]\w){2,30}(?!\w)")
_REPEAT = re.compile(r"(\w)\1{2,}")
_CAPS = re.compile(rb"(?<![A-Za-z])[A-Z]{3,}(?![a-z])")
_CAPITALS, _MARKS, _SYMBOLS = bytes(range(65, 91)), b"!?", b"#$%&*@"
_ENDS = " .,;:!?$@|+#%&*()[]\"'"
#: A disguised word is no longer than this.
LONGEST = 60

FEATURES = ["insults", "contempt", "hostile", "learned", "hits", "near_you", "you", "capitals", "caps_words", "marks", "symbols", "hidden", "spaced", "log_words"]


def _plain(token: str) -> str:
    """The word behind look-alike characters and repeated letters."""
    return _REPEAT.sub(r"\1", token.strip(_ENDS).translate(LOOKALIKES))


def _disguised(lower: str, learned: Stems) -> int:
    """Blank-separated parts that aren't abusive as they stand but are once look-alikes and repeats are undone."""
    found, done = 0, 0
    for m in _DISGUISE.finditer(lower):
        if m.start() < done:
            continue
        start = end = m.start()
        while start and start > m.start() - LONGEST and not lower[start - 1].isspace():
            start -= 1
        while end < len(lower) and end < m.start() + LONGEST and not lower[end].isspace():
            end += 1
        done, part = end, lower[start:end]
        plain, bare = _plain(part), part.strip(_ENDS)
        found += plain != bare and (plain in KNOWN or plain in learned) and not (bare in KNOWN or bare in learned)
    return found


class Stems:
    """Learned beginnings of abusive words."""

    def __init__(self, stems: Iterable[str] = ()):
        self.stems = frozenset(stems)
        self.first = frozenset(s[:STEM[0]] for s in self.stems)

    def __contains__(self, word: str) -> bool:
        return word[:STEM[0]] in self.first and any(word[:n] in self.stems for n in range(STEM[0], min(len(word), STEM[1]) + 1))


def features(text: str | None, learned: Stems = Stems()) -> list[float]:
    """The feature values of one text, in the order of FEATURES; all zero for null and empty."""
    text = text or ""
    lower, raw = text.lower(), text.encode()
    tokens = _WORD.findall(lower)
    n, first, width = max(len(tokens), 1), learned.first, STEM[0]
    hits = [i for i, t in enumerate(tokens) if t in KNOWN or t[:width] in first and t in learned]
    counts = [sum(tokens[i] in words for i in hits) for words in (*LEXICONS, learned)]
    you = [i for i, t in enumerate(tokens) if t in SECOND_PERSON]
    near = 0
    if hits and you:
        at = np.searchsorted(you, hits)
        spots, where = np.array([-LONGEST, *you, 1 << 60]), np.array(hits)
        near = int((np.minimum(where - spots[at], spots[at + 1] - where) <= NEAR).sum())
    hidden = _disguised(lower, learned)
    spaced = sum(_plain("".join(c for c in m.group() if c.isalnum())) in KNOWN for m in _SPACED.finditer(lower))
    size, per = max(len(raw), 1), 100.0 / n

    def share(letters: bytes) -> float:
        return 1 - len(raw.translate(None, letters)) / size if raw else 0.0

    return [
        *(c * per for c in counts), float(len(hits) + hidden + spaced), near * per, len(you) * per, share(_CAPITALS), len(_CAPS.findall(raw)) * per, share(_MARKS), share(_SYMBOLS),
        float(hidden), float(spaced), float(np.log1p(len(tokens))),
    ]


def featured(docs: DataFrame, learned: Stems = Stems(), text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of every row (all but the text by default) and an array column `features`."""
    keep = keep if keep is not None else [c for c in docs.columns if c != text]
    body = free_name(docs, "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = pa.array([features(t.as_py(), learned) for t in b.column(b.num_columns - 1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], values], names=[*b.schema.names[:-1], "features"])

    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias(body))
    return rows.mapInArrow(run, rows.drop(body).withColumn("features", F.array(F.lit(0.0))).schema)


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit."""

    #: Labelled rows at most, chosen by a hash of the id; a quarter of them calibrates.
    rows: int = 20_000
    #: Stems learned at most from the labelled rows.
    stems: int = 300
    #: Rows of either class that the calibrating quarter needs; with fewer, all rows fit the trees and the calibration.
    calibrating: int = 30
    trees: int = 20
    depth: int = 3
    seed: int = 11


class Model:
    """Fitted on labelled rows; scores any rows."""

    def __init__(self, learned: Stems, trees, steps: list[tuple[float, float]]):
        """trees: a fitted Spark model, or None when the labels had one class only. steps: calibration points (raw, probability), rising in both."""
        self.learned, self.trees, self.steps = learned, trees, steps

    def scored(self, docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
        """The columns `keep`, score and predicted (1 from 0.5 on)."""
        keep = keep if keep is not None else [c for c in docs.columns if c != text]
        rows = featured(docs, self.learned, text, keep)
        if self.trees is None:
            score = F.lit(self.steps[0][1] if self.steps else 0.0)
        else:
            rows = _raw(self.trees, rows)
            score = _interpolated(F.col("raw"), self.steps)
        return rows.select(*(F.col(f"`{c}`") for c in keep), score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _interpolated(x, steps: list[tuple[float, float]]):
    """Piecewise linear between calibration points, flat outside. The points are one literal array each of places, values and slopes, in which the place of x is
    found by halving, so the expression is as small for thousands of points as for ten."""
    xs, ys = (np.array(c, float) for c in zip(*steps))
    slopes = np.r_[np.diff(ys) / np.diff(xs), 0.0]
    halves = [1 << i for i in range(len(xs).bit_length() - 1, -1, -1)]
    at = F.aggregate(F.array(*map(F.lit, halves)), F.lit(0), lambda p, s: F.when((p + s < len(xs)) & (F.get(F.lit(xs), p + s) <= x), p + s).otherwise(p))
    line = F.get(F.lit(ys), at) + (x - F.get(F.lit(xs), at)) * F.get(F.lit(slopes), at)
    return F.when(x <= steps[0][0], F.lit(steps[0][1])).when(x >= steps[-1][0], F.lit(steps[-1][1])).otherwise(line)


def _raw(trees, rows: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector, vector_to_array

    found = trees.transform(rows.withColumn("vector", array_to_vector("features")))
    return found.withColumn("raw", vector_to_array("rawPrediction")[1]).drop("vector", "rawPrediction", "probability", "prediction")


def learn_stems(sample: DataFrame, most: int) -> Stems:
    """Beginnings of words that mark positive rows of (text, label): they occur in half a percent and five of the positive texts at least, and thirty times as
    often there as in the negative ones.  A longer stem gives way to a shorter one that it begins with.

    Near copies of one text count once among the positive: texts with the same least hash of three words in a row are taken for copies."""
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not n.get(1) or not n.get(0):
        return Stems()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a text has thousands of stems, so few texts are taken at a time
        for b in (b.slice(i, 50) for b in batches for i in range(0, b.num_rows, 50)):
            copies, stems = [], []
            for t in b.column(1):
                words = _LETTERS.findall((t.as_py() or "").lower())
                copies.append(min((zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(len(words) - 2, 1))), default=0))
                stems.append(list({w[:k] for w in set(words) for k in range(STEM[0], min(len(w), STEM[1]) + 1)}))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(copies, pa.int64()), pa.array(stems, pa.list_(pa.string()))], names=["label", "copies", "stems"])

    rows = sample.select("label", "text").mapInArrow(cut, "label int, copies long, stems array<string>")
    seen = rows.filter("label = 1").select("copies", F.explode("stems").alias("stem")).distinct().groupBy("stem").agg(F.count("*").alias("p")).filter(F.col("p") >= max(5, 0.005 * n[1]))
    # negative texts are looked through for those stems only
    clean = rows.filter("label = 0").select(F.explode("stems").alias("stem")).join(seen.select("stem"), "stem", "left_semi").groupBy("stem").agg(F.count("*").alias("q"))
    counts = seen.join(clean, "stem", "left").select("stem", "p", F.coalesce("q", F.lit(0)).alias("q"))
    share, other = F.col("p") / n[1], (F.col("q") + 0.5) / n[0]
    good = counts.filter(share >= 30 * other).orderBy(F.desc("p"), "stem").limit(10 * most)
    kept: dict[str, int] = {}
    for r in sorted(good.collect(), key=lambda r: (len(r["stem"]), r["stem"])):
        if not any(r["stem"][:k] in kept for k in range(STEM[0], len(r["stem"]))):
            kept[r["stem"]] = r["p"]
    return Stems(sorted(kept, key=lambda s: (-kept[s], s))[:most])


def _bound(rows: DataFrame, most: int) -> int:
    """The hash up to which at most `most` different hashes of column h lie."""
    last = rows.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    return last if last is not None else 0


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "label", training: Training = Training()) -> Model:
    """Fit on rows with a text and a 0/1 label; rows with a null label are left out.

    At most `training.rows` ids, those with the least hash, are used, each once: three quarters learn stems and trees, one quarter the calibration.
    Without rows of both classes the score is the share of positives, zero without rows.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import IsotonicRegression

    h = F.xxhash64(F.lit(training.seed), F.col(f"`{doc_id}`").cast("string"))
    rows = labelled.filter(F.col(label).isin(0, 1)).select(h.alias("h"), F.col(f"`{text}`").alias("text"), F.col(label).cast("int").alias("label"))
    rows = rows.filter(F.col("h") <= _bound(rows, training.rows)).groupBy("h").agg(F.min(F.struct("label", "text")).alias("row")).select("h", "row.label", "row.text")
    # a bounded sample would be read by a task or two; its texts are worth one for each core
    cores = labelled.sparkSession.sparkContext.defaultParallelism
    sample = staged(rows.withColumn("fold", F.pmod(F.xxhash64("h"), F.lit(4))).repartition(cores, "h"), "labelled")
    classes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        return Model(Stems(), None, [(0.0, float(classes.get(1, 0) > 0))])
    learned = learn_stems(sample.filter("fold > 0"), training.stems)
    data = staged(featured(sample, learned, keep=["h", "label", "fold"]), "features").withColumn("vector", array_to_vector("features"))
    parts = [data.filter("fold > 0"), data.filter("fold = 0")]
    held = {r["label"]: r["count"] for r in parts[1].groupBy("label").count().collect()}
    if min(held.get(0, 0), held.get(1, 0)) < training.calibrating:
        parts = [data, data]
    booster = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=training.trees, maxDepth=training.depth, stepSize=0.2, seed=training.seed, maxBins=64, minInstancesPerNode=5)
    trees = booster.fit(parts[0].select("vector", F.col("label").cast("double").alias("label")))
    raw = _raw(trees, parts[1].drop("vector")).select(F.col("label").cast("double").alias("label"), "raw")
    curve = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
    steps: list[tuple[float, float]] = []
    for x, y in zip(curve.boundaries.toArray(), curve.predictions.toArray()):
        if not steps or x > steps[-1][0]:
            steps.append((float(x), float(min(max(y, 0.0), 1.0))))
    return Model(learned, trees, steps)


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id's text leaves no remainder by five; a null id isn't held out."""
    return F.coalesce(crc_bucket(F.col(f"`{doc_id}`"), 5) == 0, F.lit(False))


def learned_from(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> Model:
    """A model of `labels.toxic` from the documents that aren't held out.

    A null id or label teaches nothing. Where an id has several labels the lesser counts, and where several documents share an id the least text. Without
    labels of both kinds the model gives all the same score.
    """
    known = labels.filter(~held_out()).select(F.col("doc_id").alias("label_id"), F.col("toxic").alias("label")).filter("label_id is not null and label is not null")
    hashed = known.withColumn("h", F.xxhash64(F.lit(training.seed), F.col("label_id").cast("string")))
    chosen = hashed.filter(F.col("h") <= _bound(hashed, training.rows)).groupBy("label_id").agg(F.min("label").alias("label"))
    # at most training.rows rows of two numbers
    return fit(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")), training=training)


def digest(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document, repeated rows and rows without an id too.

    Null and empty texts have the features of no words and are scored like any other; a null id isn't held out. No document gives no row. Other columns
    are ignored, whatever their names.
    """
    model = learned_from(docs, labels, training)
    return model.scored(docs.select("doc_id", "text")).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> DataFrame:
    """The rows of `docs` that the model doesn't call toxic, unchanged. The score is computed in the same pass, so texts aren't moved.

    Rows are judged one by one by their text: rows without an id, repeated rows, null and empty texts alike. Other columns stay, whatever their names.
    """
    model = learned_from(docs, labels, training)
    text, row = free_name(docs, "scored_text"), free_name(docs, "row")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row), F.col("`text`").alias(text))
    return model.scored(rows, text, [row]).filter("predicted = 0").select(f"{row}.*")
