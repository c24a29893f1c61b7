"""Each stage on its own input against a version by hand; the pipeline on small tables."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as pipeline
from pitwall.llm import mixing, toxicity
from pitwall.llm.encoder import Encoder
from pitwall.llm.queries import vocabulary
from test_decontaminate import brute
from test_near_dedup import brute_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_component(rows):
    codes = np.array([brute_fingerprint(r["text"], 4) for r in rows], np.uint64)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(codes[i] ^ codes[:i]) <= 4):
            a, b = root(i), root(int(j))
            label[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i])
    return [min(g, key=lambda r: r["doc_id"]) for g in groups.values()]


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    seen = {}
    stage_docs = docs
    for name, stage in pipeline.STAGES:
        out = stage(spark, stage_docs, data)
        seen[name] = (stage_docs.collect(), out.collect())
        if name != "token_files":
            assert out.columns == COLUMNS and out.schema == docs.schema
            stage_docs = spark.createDataFrame(seen[name][1], docs.schema)

    given, kept = seen["toxicity"]
    predicted = {r.doc_id: r.predicted for r in toxicity.digest(docs, spark.read.parquet(f"{data}/labels.parquet")).collect()}
    assert sorted(map(tuple, kept)) == sorted(tuple(r) for r in given if not predicted[r.doc_id])
    assert len(kept) < len(given)

    given, kept = seen["near_dedup"]
    assert sorted(map(tuple, kept)) == sorted(map(tuple, by_component(given)))
    assert len(kept) < len(given)

    given, kept = seen["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    bad = {r[0] for r in brute([tuple(r)[:2] for r in given], items) if r[4]}
    assert sorted(map(tuple, kept)) == sorted(tuple(r) for r in given if r.doc_id not in bad)

    given, kept = seen["mixing"]
    plan = {r.doc_id: r.copies for r in mixing.mixed(spark.createDataFrame(given, docs.schema)).collect()}
    assert Counter(map(tuple, kept)) == Counter({tuple(r): plan[r.doc_id] for r in given if plan[r.doc_id]})

    given, told = seen["token_files"]
    tok, start, want = Encoder(vocabulary()).tokenizer, 0, []
    for r in sorted(given, key=lambda r: r.doc_id):
        ids = [*tok.encode(r.text, add_special_tokens=False).ids, 2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, told)) == want


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 3 + [(1, "", None, "a", 0), (1, "", None, "a", 0), (2, "one two " * 50_000, "en", None, 9), (3, "One  two " * 50_000, "en", "b", 9)]])
def test_odd_tables(spark, tables, rows):
    documents = "doc_id long, text string, lang string, source string, n_chars long, fp string, position int, body string"
    wide = [(*r, "x", 1, "y") for r in rows]
    folder = tables(spark, documents=spark.createDataFrame(wide, documents), labels=spark.createDataFrame([(None, None, None)] if rows else [], "doc_id long, quality int, toxic int"),
                    benchmark=spark.createDataFrame([(1, None)] if rows else [], "item_id long, text string"))
    out = pipeline.run(spark, folder).collect()
    assert bool(out) == bool(rows) and all(r.n_tokens >= 1 for r in out)
