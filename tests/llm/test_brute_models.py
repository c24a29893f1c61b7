"""Fitted models against plain Python: every score recomputed from the fitted centroids, or trees and curve."""

import math
import random

import numpy as np
import pytest

from pitwall.llm import language_id, toxicity
from test_language_id import corpus as languages
from test_language_id import DOCS as LANGUAGE_DOCS
from test_toxicity import DOCS as TOXIC_DOCS
from test_toxicity import corpus as toxic


def runs_of_letters(text):
    """All runs of one to three characters of a lower-cased text in which every stretch of other characters is one blank, as plain strings; a lone blank isn't one."""
    letters = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    return [letters[i : i + n] for n in (1, 2, 3) for i in range(len(letters) - n + 1) if letters[i : i + n] != " "]


def counts_by_hand(text, dimensions):
    """The hash of each run in whole numbers."""
    mix, shift, out = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), 64 - dimensions.bit_length() + 1, {}
    mask = (1 << 64) - 1
    for run in runs_of_letters(text):
        h = ord(run[0]) * mix[0] & mask
        for k, c in enumerate(run[1:], 1):
            h = h * mix[k] + ord(c) * mix[0] & mask
        at = (h * mix[1] & mask ^ (h >> 29) * mix[2] & mask) >> shift
        out[at] = out.get(at, 0) + 1
    return out


def test_languages_from_the_centroids(spark):
    rows = [r for r in languages(300) if r[1] is None or len(r[1]) < 5000]
    training = language_id.Training(dimensions=1024)
    docs = spark.createDataFrame(rows, LANGUAGE_DOCS)
    model = language_id.fit(docs.filter("doc_id is not null"), training)
    got = language_id.identified(docs.select("doc_id", "text"), model, training, keep=["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    centres = [[float(x) for x in c] for c in model.centres]
    for r in got:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        weights = {k: math.log1p(n) * float(model.idf[k]) for k, n in counts_by_hand(r.text, 1024).items()}
        size = math.sqrt(sum(w * w for w in weights.values()))
        cosine = [sum(w * c[k] for k, w in weights.items()) / size for c in centres]
        best = max(range(len(cosine)), key=cosine.__getitem__)
        assert r.score == pytest.approx(min(max(cosine[best], 0), 1), abs=1e-4)
        near = [model.languages[model.owner[j]] for j in range(len(cosine)) if cosine[j] > cosine[best] - 1e-5]
        assert r.lang_pred in near
        if abs(cosine[best] - model.least[model.owner[best]]) > 1e-4:
            assert r.rejected == (cosine[best] < model.least[model.owner[best]])


def leaf(node, x):
    """A tree's prediction by walking its nodes."""
    while node.numDescendants():
        split = node.split()
        node = node.leftChild() if x[split.featureIndex()] <= split.threshold() else node.rightChild()
    return node.prediction()


def test_scores_from_the_trees_and_the_curve(spark, words):
    docs, labels, _ = toxic(words, 500)
    df, known = spark.createDataFrame(docs, TOXIC_DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.learned_from(df, known)
    rng = random.Random(1)
    asked = rng.sample(docs, 120) + [(9000, None, None, "x", None, 1), (9001, "", None, "x", None, 1)]
    got = {r.doc_id: r for r in model.scored(spark.createDataFrame(asked, TOXIC_DOCS).select("doc_id", "text")).collect()}
    roots = [(w, t._call_java("rootNode")) for w, t in zip(model.trees.treeWeights, model.trees.trees)]
    xs, ys = zip(*model.steps)
    assert list(xs) == sorted(set(xs)) and list(ys) == sorted(ys)
    for doc_id, text, *_ in asked:
        x = toxicity.features(text, model.learned)
        margin = sum(w * leaf(root, x) for w, root in roots)
        assert got[doc_id].score == pytest.approx(float(np.interp(margin, xs, ys)), abs=1e-9)
        assert got[doc_id].predicted == (got[doc_id].score >= 0.5)


def test_conflicting_labels_take_the_lesser(spark, words):
    docs, labels, _ = toxic(words, 300)
    df = spark.createDataFrame(docs, TOXIC_DOCS)
    schema = "doc_id long, quality int, toxic int"
    plain = toxicity.learned_from(df, spark.createDataFrame(labels, schema))
    clean = [(i, 1, 1) for i, _, t in labels if t == 0]
    both = toxicity.learned_from(df, spark.createDataFrame(labels + clean, schema))
    assert both.steps == plain.steps and both.learned.stems == plain.learned.stems
