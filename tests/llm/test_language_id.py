import random
import zlib
from collections import Counter

import numpy as np

from pitwall.llm import language_id
from pitwall.llm.language_id import Training, digest, ngram_counts

DOCS = "doc_id long, text string, lang string, body string, score string, lang_pred int"
PARTS = {"en": "the and ing tion er of ea sh wh", "de": "der und ung ein sch ich keit ä ü", "fr": "les eau tion é è ou que ç ment", "es": "ción ñ ar os la do que ll ez"}


def text_of(rng, lang, n):
    parts = PARTS[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))).title() for _ in range(n))


def test_counts_do_not_depend_on_runs(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("abcÄß é.. 12\n日") for _ in range(5000))
    whole = ngram_counts(text, 4096)
    for run in (1, 2, 7, 64):
        monkeypatch.setattr(language_id, "RUN", run)
        assert (ngram_counts(text, 4096) == whole).all()
    letters = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    padded = " " + " ".join(letters) + " "
    want = sum(map(len, letters)) + (len(padded) - 1) + (len(padded) - 2)
    assert whole.sum() == want
    assert ngram_counts("", 64) is None and ngram_counts("123 !?", 64) is None and ngram_counts("a", 64).sum() == 1 + 2 + 1
    assert (ngram_counts("ab", 1024) != ngram_counts("ba", 1024)).any()
    assert Counter(np.flatnonzero(ngram_counts("aaaa", 1 << 16))).total() <= 7


def corpus(n):
    rng = random.Random(8)
    rows = [(i, text_of(rng, lang, rng.randint(5, 60)), lang, "x", "y", 1) for i in range(n) for lang in [rng.choice(["en"] * 4 + ["de", "fr", "es"])]]
    return [*rows, (n, None, "en", None, None, None), (n + 1, "", "en", None, None, None), (n + 2, "12 ?!", "de", None, None, None), (None, text_of(rng, "fr", 50), "fr", None, None, None),
            (n + 3, text_of(rng, "es", 40), None, None, None, None), (n + 4, text_of(rng, "de", 60_000), "de", None, None, None), (n + 5, "ελληνικά κείμενα " * 30, None, None, None, None)]


def test_held_out_accuracy(spark):
    rows = corpus(1200)
    got = digest(spark.createDataFrame(rows, DOCS), Training(rows=400)).collect()
    truth = {r[0]: r[2] for r in rows}
    assert len(got) == len(rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out and r.doc_id < 1200]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) / len(out) > 0.98
    by = {r.doc_id: r for r in got}
    assert [by[1200 + i].lang_pred for i in range(3)] == ["und"] * 3
    assert by[1203].lang_pred == "es" and by[1204].lang_pred == "de" and by[None].lang_pred == "fr"
    assert by[1205].rejected and not by[1203].rejected


def test_labels_ids_and_sources_do_not_reach_a_prediction(spark):
    rows = corpus(300)
    first = {r.doc_id: r for r in digest(spark.createDataFrame(rows, DOCS)).collect()}
    changed = [(i, t, "de" if i is not None and zlib.crc32(str(i).encode()) % 4 == 2 else lang, *rest) for i, t, lang, *rest in rows]
    assert {r.doc_id: r for r in digest(spark.createDataFrame(changed, DOCS).repartition(5)).collect()} == first


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some words", None, None, None, None)], DOCS)
    assert [(r.lang_pred, r.score) for r in digest(df).collect()] == [("und", 0.0)]
    assert digest(spark.createDataFrame([], DOCS)).count() == 0
    one = spark.createDataFrame([(i, "some words", "en", None, None, None) for i in range(8)], DOCS)
    assert {r.lang_pred for r in digest(one).collect()} == {"en"}
