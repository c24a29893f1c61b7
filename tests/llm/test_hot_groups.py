"""Inputs that were too much for one task or one expression."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.llm import decontaminate, near_dedup, token_files, toxicity
from pitwall.llm.fingerprints import with_edits
from pitwall.llm.hamming import GrayIndex


def crowded(n, shared, seed):
    """Values that agree in their leading bits, in balls of near ones."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << shared, n // 8, dtype=np.uint64)
    out = np.repeat(centres, 8)
    for _ in range(3):
        out = out ^ np.where(rng.random(len(out)) < 0.4, np.uint64(1) << rng.integers(0, shared, len(out)).astype(np.uint64), np.uint64(0))
    return np.unique(out | np.uint64(0x5A5A5A << 40) if shared <= 40 else out)


def parts(values, radius):
    """Components by comparing all values with all."""
    label = np.arange(len(values))
    order = np.argsort([int(v) ^ int(v) >> 1 for v in values])
    del order
    while True:
        low = label.copy()
        for i in range(len(values)):
            near = np.bitwise_count(values ^ values[i]) <= radius
            low[i] = label[near].min()
        low = low[low]
        if (low == label).all():
            return label
        label = low


@pytest.mark.parametrize("branch, pairs", [(0, 1), (2, 5), (6, 1000)])
def test_one_hot_node_against_brute_force(spark, monkeypatch, branch, pairs):
    values = crowded(1600, 40, 1)
    for name, v in (("LEAF", 16), ("BRANCH_BITS", branch), ("PAIRS", pairs), ("NODE", 1 << 40)):
        monkeypatch.setattr(near_dedup, name, v)
    fps = spark.createDataFrame([(i, int(np.int64(v.view(np.int64)))) for i, v in enumerate(values)], "doc_id long, fp long").repartition(4)
    label = parts(values, 4)
    smallest = {}
    for i, l in enumerate(label):
        smallest[l] = min(smallest.get(l, i), i)
    want = {int(v.view(np.int64)): smallest[l] for v, l in zip(values, label)}
    got = {r.fp: r.component_id for r in near_dedup.labelled(fps, 4).collect()}
    assert got == want
    assert 1 < len(set(want.values())) < len(values)


def test_pairs_of_a_hot_node_are_dealt_evenly(spark, monkeypatch):
    """One node has nearly all leaves: tasks get the same number of pairs of leaves, give or take."""
    monkeypatch.setattr(near_dedup, "PAIRS", 200)
    monkeypatch.setattr(near_dedup, "LEAF", 32)
    n = 300
    rng = random.Random(3)
    rows = [(0, 7 if i < n - 10 else i, i, 0, 0) for i in range(n)]
    leaves = spark.createDataFrame(rows, "tab int, node long, seq long, mask long, pattern long")
    found = near_dedup._near_leaves(leaves, 4).cache()
    assert found.count() == 290 * 289 // 2 and rng
    tasks = 1 + found.count() // near_dedup.PAIRS
    dealt = [r["count"] for r in found.repartition(tasks, "a", "b").groupBy(F.spark_partition_id()).count().collect()]
    assert max(dealt) < 2 * sorted(dealt)[len(dealt) // 2]
    times = [r["count"] for r in found.groupBy("a").count().collect()]
    assert max(times) < 2 * sorted(times)[len(times) // 2]
    assert GrayIndex(np.zeros(1, np.uint64)).size == 1


def test_clean_with_clashing_names(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"x {item} y", 5, "a", "b"), (2, "quite another text", 5, "a", "b"), (None, item, 1, None, None), (3, None, 0, "", "")], "doc_id long, text string, hit_id int, hit_t string, HIT_ID_ string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.clean(docs, bench, 10)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [2, 3]
    digest = decontaminate.digest(docs, bench).collect()
    assert sorted((str(r.doc_id), r.contaminated) for r in digest) == [("1", True), ("2", False), ("3", False), ("None", True)]


def test_thousands_of_calibration_points(spark):
    rng = np.random.default_rng(1)
    xs, ys = np.unique(rng.standard_normal(5000)), np.sort(rng.random(5000))
    steps = list(zip(xs.tolist(), ys.tolist()))
    ask = np.r_[rng.standard_normal(2000) * 2, xs[:50], xs[-1], -99.0, 99.0]
    rows = spark.createDataFrame([(float(x),) for x in ask], "x double").select("x", toxicity._interpolated(F.col("x"), steps).alias("y")).collect()
    assert np.allclose([r.y for r in rows], np.interp([r.x for r in rows], xs, ys))


def test_every_partition_head_meets_the_one_before(spark):
    rows = [(i, f"text {i} " * (i % 7 + 1)) for i in range(200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: r for r in with_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(9)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == 200 and all(got[i].next_fp == got[(i - 1) % 200].fp for i in range(200))


def test_token_folders_with_and_without_scheme(spark, tmp_path):
    from pitwall.llm.queries import vocabulary

    docs = spark.createDataFrame([(2, "two words"), (1, "one")], "doc_id long, text string")
    told = []
    for root in (str(tmp_path / "a"), f"file:{tmp_path}/b", f"file://{tmp_path}/c"):
        token_files.write(docs, root, vocabulary(), end_id=2)
        told.append(sorted(map(tuple, token_files.documents(spark, root).collect())))
    assert told[0] == told[1] == told[2] and len(told[0]) == 2
    # a path without a scheme is where Spark would put it
    assert token_files.qualified(spark, "/x/y") == "file:/x/y"
    for root in ("dbfs:/x", "nosuch://x/y"):
        with pytest.raises(Exception):
            token_files.write(docs, root, vocabulary(), end_id=2)
