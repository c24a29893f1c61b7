import random
import zlib

import pytest

from pitwall.llm import toxicity
from pitwall.llm.toxicity import FEATURES, Stems, features

DOCS = "doc_id long, text string, lang string, features string, score string, row int"


def value(text, name, learned=Stems()):
    return features(text, learned)[FEATURES.index(name)]


def test_features():
    assert features(None) == features("") == [0.0] * len(FEATURES)
    assert value("you idiot", "insults") == 50 and value("you idiot", "near_you") == 50
    assert value("idiot " + "word " * 9 + "you", "near_you") == 0
    assert value("x" * 3 + " you 1d10t, m0r0n!!! st00pid", "hidden") == 2
    assert value("what a looooser", "hidden") == 1 and value("see i d i o t and s.c.u.m", "spaced") == 2
    assert value("SHOUT LOUD ok", "caps_words") == pytest.approx(200 / 3)
    assert value("grumpf zorkish", "learned", Stems(["zork", "grumpfen"])) == 50
    assert value("agreed, 100 dollars!", "hits") == 0
    assert value("idiot$$$ and&&&", "hits") == 1


def test_huge_text_and_lone_runs():
    assert value("a" * 1_000_000, "hits") == 0
    assert value("1" * 300_000 + " scum", "hits") == 1
    assert value("word " * 300_000 + "trash", "contempt") > 0


def corpus(words, n=1500):
    rng, docs, labels = random.Random(6), [], []
    for i in range(n):
        toxic = rng.random() < 0.15
        text = rng.choices(words, k=rng.randint(20, 120))
        if toxic:
            for _ in range(rng.randint(2, 5)):
                text.insert(rng.randrange(len(text)), rng.choice(["idiot", "you moron", "zorkish", "m0ron", "L o s e r", "WORTHLESS", "trash"]))
        elif rng.random() < 0.02:
            text.insert(3, "trash")
        docs.append((i, " ".join(text), None, "x", None, 1))
        if rng.random() < 0.6:
            labels.append((i, 1, int(toxic)))
    truth = {d[0]: any(w in d[1] for w in ("idiot", "moron", "zorkish", "m0ron", "L o s e r", "WORTHLESS")) for d in docs}
    return docs, labels, truth


def test_held_out_accuracy_and_flags(spark, words):
    docs, labels, truth = corpus(words)
    docs += [(5000, None, None, None, None, None), (5001, "", None, None, None, None), (None, "you idiot moron scum", None, None, None, None), (3, docs[3][1], None, None, None, None)]
    labels += [(None, 1, 1), (9, None, None), (10, 1, None)]
    got = toxicity.digest(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    out = [r for r in got if r.held_out and r.doc_id in truth]
    right = sum(bool(r.predicted) == truth[r.doc_id] for r in out)
    assert right / len(out) > 0.95
    assert all(r.predicted == 0 for r in got if r.doc_id in (5000, 5001))


def test_clean_rows_stay(spark, words):
    docs, labels, truth = corpus(words, 700)
    df = spark.createDataFrame(docs, DOCS)
    got = toxicity.without_toxic(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == df.columns
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) <= set(docs)
    kept = {r[0] for r in rows}
    clean = [i for i in truth if not truth[i]]
    assert sum(i in kept for i in clean) / len(clean) > 0.97 and sum(i in kept for i in truth if truth[i]) / sum(truth.values()) < 0.1


def test_no_labels_one_class_and_empty(spark, words):
    docs, labels, _ = corpus(words, 60)
    df, schema = spark.createDataFrame(docs, DOCS), "doc_id long, quality int, toxic int"
    for lab, want in (([], 0), ([(i, 1, 0) for i in range(50)], 0), ([(i, 1, 1) for i in range(50)], 1)):
        assert {r.predicted for r in toxicity.digest(df, spark.createDataFrame(lab, schema)).collect()} == {want}
    assert toxicity.digest(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, schema)).count() == 0


def test_interpolation(spark):
    steps = [(0.0, 0.1), (1.0, 0.5), (3.0, 0.9)]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in (-1.0, 0.0, 0.5, 1.0, 2.0, 3.0, 9.0)], "x double").select(toxicity._interpolated(toxicity.F.col("x"), steps)).collect()]
    assert got == pytest.approx([0.1, 0.1, 0.3, 0.5, 0.7, 0.9, 0.9])
