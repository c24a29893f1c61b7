import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pitwall.llm.repeats import digest, without_repeats
from pitwall.llm.suffix_sort import sort_windows

SCHEMA = "doc_id long, text string"


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 1 << 30), st.sampled_from([16, 17, 24, 25, 50, 51, 64]), st.sampled_from([1, 2, 3, 26]), st.sampled_from([8, 24]), st.sampled_from([2, 4, 16]))
def test_windows_come_in_byte_order(seed, length, letters, shallow, blind):
    rng = random.Random(seed)
    data = bytes(rng.randrange(letters) for _ in range(rng.choice([70, 300, 700])))
    data += data[: rng.choice([0, 200])] + bytes([255]) * rng.choice([0, 90])
    at = np.array([p for p in range(len(data) - length + 1) if rng.random() < 0.7], np.int64)
    order, new = sort_windows(np.frombuffer(data, np.uint8), at, length, shallow, blind)
    got = [data[p : p + length] for p in at[order]]
    assert got == sorted(got)
    assert list(new) == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


def brute(rows, length):
    """Every window against every other, by a dictionary of all windows."""
    after = 1 << 70
    first, out = {}, []
    for i, t in rows:
        t = (t or "").encode()
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            first[w] = min(first.get(w, after), after if i is None else i)
    for i, t in rows:
        t = (t or "").encode()
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < (after if i is None else i):
                gone[p : p + length] = b"\1" * length
        spans = sum(gone[j] and not (j and gone[j - 1]) for j in range(len(t)))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def corpus(words):
    rng = random.Random(11)
    words = words[:60] + ["é", "日本"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passages, rows = [text(80) for _ in range(10)], []
    for _ in range(120):
        t, kind = text(rng.choice([0, 1, 5, 30, 100])), rng.random()
        if kind < 0.5:
            p = rng.choice(passages)
            at = rng.randrange(len(p) - 60)
            t += p[at : at + rng.choice([49, 50, 51, 60, 200])] + text(rng.choice([0, 3, 10]))
        elif kind < 0.6:
            t = rng.choice(passages)
        elif kind < 0.7:
            t = rng.choice(["a", "ab", "é"]) * rng.choice([10, 25, 26, 49, 50, 51, 300])
        elif kind < 0.73:
            t = None
        rows.append((rng.choice([None, *range(-50, 150)]), t))
    return rows


@pytest.mark.parametrize("division", [{}, {"block": 2000, "bucket": 1500}, {"block": 2000, "bucket": 1500, "common": 2}, {"length": 17, "block": 900, "bucket": 3000, "common": 1}])
def test_against_brute_force(spark, words, division):
    rows = corpus(words)
    got = without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3), **division).collect()
    shaped = [(r.doc_id, r.n_bytes, sum(e - s for s, e in zip(r.starts, r.ends)), len(r.starts), hashlib.sha256(r.kept).hexdigest()) for r in got]
    assert sorted(shaped, key=repr) == brute(rows, division.get("length", 50))


def test_one_common_line_among_unlike_neighbours(spark, words):
    rng = random.Random(2)
    line = " ".join(words[:12])
    rows = [(i, " ".join(rng.choice(words) for _ in range(9)) + line + " ".join(rng.choice(words) for _ in range(9))) for i in range(200)]
    got = without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(4), block=3000, bucket=2000, common=3).selectExpr("doc_id", "n_bytes", "n_bytes - octet_length(kept) n", "size(starts) k", "sha2(kept, 256) h")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 50)


def test_whole_long_text_meets_its_copy(spark, words):
    rng = random.Random(5)
    long = " ".join(rng.choice(words) + str(rng.random()) for _ in range(40_000))
    got = {r.doc_id: r for r in digest(spark.createDataFrame([(2, "x" + long), (1, long), (3, None), (4, "")], SCHEMA)).collect()}
    size = len(long)
    assert (got[1].n_removed, got[1].n_spans, got[1].n_bytes) == (0, 0, size)
    assert (got[2].n_removed, got[2].n_spans, got[2].kept_sha256) == (size, 1, hashlib.sha256(b"x").hexdigest())
    assert all((got[i].n_bytes, got[i].n_removed, got[i].kept_sha256) == (0, 0, hashlib.sha256(b"").hexdigest()) for i in (3, 4))


def test_empty_tables_clashing_names_and_refused_lengths(spark):
    assert digest(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([(1, "q" * 60, "x", 2), (2, "q" * 60, "y", 3), (2, "q" * 60, "z", 3)], "doc_id long, text string, kept string, block int")
    assert sorted((r.doc_id, r.n_removed) for r in digest(clash).collect()) == [(1, 0), (2, 60), (2, 60)]
    for length in (15, 65):
        with pytest.raises(ValueError):
            without_repeats(clash, length)
