import random
import re

import numpy as np
import pytest
import xxhash

from pitwall.llm import hamming, near_dedup
from pitwall.llm.components import connected_components
from pitwall.llm.near_dedup import linked, near_duplicates, one_per_component, shingle_simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                label[root(i)] = root(j)
    out = []
    for i in range(len(fps)):
        members = [ids[j] for j in range(len(fps)) if root(j) == root(i) and ids[j] is not None]
        out.append(min(members) if members else None)
    return out


def corpus(words):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 40, 300]))]
        for _ in range(rng.choice([1, 1, 3])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(rng.choice([" ", "  ", "\n"]).join(copy))
    rows += ["", None, "   ", "Ünï Ünï", "É É É É É", "A b C d", "a B c D", "x y z"]
    return rows


def test_fingerprints_and_components_match_brute_force(spark, words):
    texts = corpus(words)
    ids = [1000 - 3 * i for i in range(len(texts))]
    ids[5] = None
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {(r.doc_id, r.fp % (1 << 64), r.component_id) for r in near_duplicates(df, 4, 4).collect()}
    fps = [brute_fingerprint(t, 4) for t in texts]
    assert got == set(zip(ids, fps, brute_components(ids, fps, 4)))


def test_huge_text_in_runs(words):
    rng = random.Random(1)
    text = " ".join(rng.choice(words) for _ in range(700_000))
    assert len(text) > 3 << 20
    assert shingle_simhash(text.encode(), 4) == brute_fingerprint(text, 4)


def ball(n, seed=5):
    rng = random.Random(seed)
    base = rng.getrandbits(64)
    out = set()
    while len(out) < n:
        code = base
        for _ in range(rng.randint(0, 7)):
            code ^= 1 << rng.randrange(64)
        out.add(code)
    return sorted(out)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("node", [4096, 4])
def test_large_top_nodes_are_split_and_nothing_is_lost(spark, monkeypatch, node):
    monkeypatch.setattr(near_dedup, "NODE", node)
    codes = ball(3000) + [random.Random(i).getrandbits(64) for i in range(500)]
    df = spark.createDataFrame([(signed(c),) for c in codes], "fp long")
    links = linked(df, 4)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    arr = np.array(codes, np.uint64)
    a, b = np.nonzero(np.bitwise_count(arr[:, None] ^ arr[None, :]) <= 4)
    label = hamming.components(len(codes), a, b)
    want = {}
    for i, c in enumerate(codes):
        want.setdefault(int(label[i]), set()).add(signed(c))
    got = {}
    for c in map(signed, codes):
        got.setdefault(roots.get(c, c), set()).add(c)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))
    assert links.count() < 60_000 * (1 + (node == 4))


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(2)
    codes = np.unique(np.r_[rng.integers(0, 1 << 62, 700).astype(np.uint64), np.array(ball(500), np.uint64)])
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    codes = codes[np.argsort(rank)]
    for queries in (codes, codes[::7]):
        q, c = hamming.GrayIndex(codes).search(queries, 4)
        want = np.nonzero(np.bitwise_count(queries[:, None] ^ codes[None, :]) <= 4)
        assert set(zip(q.tolist(), c.tolist())) == set(zip(*(x.tolist() for x in want)))


def test_block_tables_share_a_key_within_the_radius():
    rng = random.Random(4)
    for radius, blocks in ((3, 4), (4, 5), (3, 6)):
        orders = hamming.block_tables(radius, blocks)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), radius):
                b ^= 1 << bit
            assert any(all((a >> s) & ((1 << w) - 1) == (b >> s) & ((1 << w) - 1) for s, w in o[: blocks - radius]) for o in orders)
        assert all(sum(w for _, w in o) == 64 for o in orders)


def test_chain_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 500: 500, 501: 500}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_component_stays(spark, words):
    long = " ".join(words)
    rows = [(5, long, "en", "s", 1), (3, long, None, None, None), (9, words[0] * 3, "en", "s", 1), (None, words[1] * 3, "en", "s", 1), (None, words[1] * 3, "en", "s", 1), (9, words[0] * 3, "en", "s", 1),
            (11, "", "x", "y", 0), (12, None, "x", "y", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = one_per_component(df, 4, 4)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([rows[1], rows[2], rows[3], rows[6]], key=repr)
    plain = spark.createDataFrame(rows[:3], SCHEMA)
    assert sorted(r.doc_id for r in one_per_component(plain, 4, 4).collect()) == [3, 9]


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA + ", fp string, root int, body string")
    assert near_duplicates(df, 4, 4).count() == 0 and one_per_component(df, 4, 4).count() == 0
    full = spark.createDataFrame([(1, "a b", "en", "s", 3, "fp", 1, "body")], df.schema)
    assert [tuple(r) for r in one_per_component(full, 4, 4).collect()] == [(1, "a b", "en", "s", 3, "fp", 1, "body")]
