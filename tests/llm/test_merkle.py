import hashlib
import random
import zlib

import numpy as np
import pytest

from pitwall.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r):
    return sha("".join("-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in ("doc_id", "source", "lang", "n_chars", "text")))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, i):
    out = []
    for level in tree[:-1]:
        low = i // 8 * 8
        out.append(("".join(level[low:i]), "".join(level[i + 1 : low + 8])))
        i //= 8
    return out


def brute(rows):
    """All levels of all trees as plain lists."""
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    rows_of = {g: sorted((r for r in rows if r["lang"] == g), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for g in langs}
    trees = {g: levels([leaf(r) for r in rows_of[g]]) for g in langs}
    top = levels([trees[g][-1][0] for g in langs])
    root, out = top[-1][0], []
    for t, g in enumerate(langs):
        for i, r in enumerate(rows_of[g]):
            way, now = path(trees[g], i) + path(top, t), leaf(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"]:
                now = leaf(dict(r, text="".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])))
            for left, right in way:
                now = sha(left + now + right)
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], root, sha("".join(a + b for a, b in way)), now, now == root))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], SCHEMA).repartition(3)


def made(n, langs):
    rng = random.Random(n)
    return [
        {"doc_id": rng.choice([None, *range(n * 3)]), "text": rng.choice([None, "", "Aé b", "lower", f"X{rng.randrange(99)}"]), "lang": rng.choice(langs), "source": rng.choice([None, "a"]), "n_chars": rng.choice([None, 3])}
        for _ in range(n)
    ]


@pytest.mark.parametrize("n, langs", [(1, ["a"]), (9, ["a"]), (700, ["de", None, "en", "é", "Z", "", "a"]), (300, [str(i) for i in range(120)]), (9000, ["a", "a", "a", "b"])])
def test_against_plain_lists(spark, n, langs):
    rows = made(n, langs)
    got = [tuple(r) for r in merkle.digest(table(spark, rows)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_order_of_nodes_is_van_emde_boas():
    for levels_ in range(1, 6):
        places = np.concatenate([merkle.address(levels_, d, np.arange(8**d)) for d in range(levels_)])
        assert sorted(places) == list(range(merkle.nodes_in(levels_)))
    # four levels: the upper two first, then each of the sixty-four lower pairs of levels as one run
    assert [int(merkle.address(4, 1, i)) for i in range(8)] == list(range(1, 9))
    assert [int(merkle.address(4, 2, i)) for i in range(3)] == [9, 18, 27]
    assert [int(merkle.address(4, 3, i)) for i in range(9)] == [*range(10, 18), 19]


def test_proofs_lead_to_the_root_and_break_on_change(spark):
    rows = table(spark, made(200, ["a", "b", None])).withColumn("leaf", merkle.leaf_digest([merkle.F.col(c) for c in merkle.FIELDS]))
    manifest = merkle.build(merkle.staged(rows, "rows"), "lang", ["doc_id"], "leaf", ["doc_id"])
    for r in manifest.proofs().collect():
        way = [(s.left, s.right) for s in r.path]
        assert merkle.folded(r.leaf, way) == r.root == manifest.root
        assert merkle.folded(sha(r.leaf), way) != r.root


def test_equal_rows_other_columns_and_no_rows(spark):
    rows = [{"doc_id": 4, "text": "T", "lang": "x", "source": None, "n_chars": 1}] * 20
    got = merkle.digest(table(spark, rows).withColumns({"root": merkle.F.lit(1), "tree": merkle.F.lit(2)})).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert merkle.digest(spark.createDataFrame([], SCHEMA)).collect() == []
