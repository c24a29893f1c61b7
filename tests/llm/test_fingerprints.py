import hashlib
import random

import numpy as np
import pytest

from pitwall.llm import fingerprints
from pitwall.llm.fingerprints import digest, edited_text, near_counts, neighbours, simhash, word_hashes
from pitwall.llm.hamming import blocks_for

DOCS = "doc_id long, text string, lang string, fp string, part int, kind string, head int"


def test_equal_words_hash_alike_wherever_they_are(monkeypatch):
    rng = random.Random(2)
    words = ["é" * rng.randint(1, 4) + "ab" * rng.randint(0, 3) for _ in range(300)]
    sep = [" ", "  ", "\n", "\t \x0b"]
    text = "".join(w + rng.choice(sep) for w in words).encode()
    hashes = word_hashes(text)
    by = {}
    for w, h in zip(words, hashes, strict=True):
        by.setdefault(w, set()).add(int(h))
    assert all(len(x) == 1 for x in by.values()) and len({next(iter(x)) for x in by.values()}) == len(by)
    for run in (1, 3, 50):
        monkeypatch.setattr(fingerprints, "RUN", run)
        # a word longer than two runs is cut, so runs here are only compared with words that fit
        if run == 50:
            assert (word_hashes(text) == hashes).all()
        else:
            assert len(word_hashes(text)) >= len(hashes)
    assert len(word_hashes(b"")) == len(word_hashes(b" \n")) == 0


def test_simhash():
    rng = random.Random(4)
    words = ["w%d" % rng.randrange(5000) for _ in range(600)]
    base = simhash(" ".join(words).encode())
    assert simhash("\n".join(words).upper().encode()) == base and simhash(b"") == simhash(b" ") == 0 and simhash(b"one") != 0
    near = list(words)
    near[300] = "other"
    other = ["v%d" % rng.randrange(5000) for _ in range(600)]
    bits = [bin(base ^ simhash(" ".join(w).encode())).count("1") for w in (near, words[:300] + other[:300], other)]
    assert bits[0] <= 6 and bits[0] < bits[1] < bits[2]


def line(rows):
    """The contract by hand: (doc_id, text) rows, each with the text after it."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [t or "" for _, t in rows]
    return [(i, t, texts[(k + 1) % len(texts)]) for k, ((i, _), t) in enumerate(zip(rows, texts))]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 300])
def test_edits_and_neighbours(spark, words, n):
    rng = random.Random(n)
    ids = rng.sample(range(-500, 5000), n)
    rows = [(i, rng.choice([None, "", "é", "日本語 😀 text"]) if rng.random() < 0.1 else " ".join(rng.choices(words, k=rng.randint(1, 80)))) for i in ids]
    if n == 300:
        rows += [(None, "lost"), (None, None), (ids[0], rows[0][1]), (ids[1], "another"), (100, words[0] * 2), (200, words[0] * 2), (300, words[0] * 2)]
    df = spark.createDataFrame([(*r, "l", "f", 1, "k", 2) for r in rows], DOCS).repartition(6)
    got = digest(df).collect()
    want = []
    for doc_id, text, following in line(rows):
        edited = edited_text(text, following)
        f, e, x = (simhash(t.encode()) for t in (text, edited, following))
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{f:016x}", f"{e:016x}", 1 - bin(f ^ e).count("1") / 64, 1 - bin(f ^ x).count("1") / 64))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:7]) for r in got)
    fps = [int(r.fingerprint, 16) for r in got]
    for r in got:
        assert r.n_near == (None if r.doc_id is None or r.doc_id % 100 else sum(bin(int(r.fingerprint, 16) ^ f).count("1") <= 3 for f in fps))


@pytest.mark.parametrize("radius, blocks", [(3, 4), (3, 5), (4, 6)])
def test_block_tables_find_all_neighbours(spark, radius, blocks):
    rng = np.random.default_rng(radius)
    base = rng.integers(-(1 << 63), 1 << 62, 40)
    codes = {int(c) for c in base}
    for c in base:
        for _ in range(20):
            x = int(c)
            for bit in rng.choice(64, rng.integers(1, 7), replace=False):
                x ^= 1 << int(bit)
            codes.add(x - (1 << 64) if x >> 63 == 1 else x if x < 1 << 63 else x)
    codes = sorted(c if -(1 << 63) <= c < 1 << 63 else c - (1 << 64) if c > 0 else c + (1 << 64) for c in codes)
    arr = np.array(codes, np.int64).view(np.uint64)
    queries = arr[::5]
    df, qdf = (spark.createDataFrame([(int(c),) for c in a.view(np.int64)], "fp long") for a in (arr, queries))
    near = np.bitwise_count(queries[:, None] ^ arr[None, :])
    want = {(int(queries.view(np.int64)[i]), int(arr.view(np.int64)[j]), int(near[i, j])) for i, j in zip(*np.nonzero(near <= radius))}
    assert {tuple(r) for r in neighbours(qdf, df, radius, blocks).collect()} == want
    assert {(r.q, r.n) for r in near_counts(df.union(df), qdf, radius).collect()} == {(int(q), 2 * int((near[i] <= radius).sum())) for i, q in enumerate(queries.view(np.int64))}


def test_keys_grow_with_the_number_of_values():
    assert blocks_for(0, 3) == blocks_for(1000, 3) == 4
    assert blocks_for(1 << 22, 3) == 5 and blocks_for(1 << 33, 3) > 5
