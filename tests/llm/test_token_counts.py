import random

import pytest

from pitwall.llm.encoder import Encoder
from pitwall.llm.token_counts import LEAF, CountTree, counted, digest

tokenizers = pytest.importorskip("public_tokenizers")
PATH = tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "word", " ", "  ", "\n", "\n\n", "é", "12", "'s", ".", "<|endoftext|>", "日本", "\t", "Ünïcode ", " the", "᠎", "\x1c"]


def full(enc, text):
    return len(enc.tokenizer.encode(text, add_special_tokens=False).ids)


def test_any_edits_count_like_a_full_encoding():
    rng, enc = random.Random(3), Encoder(PATH)
    for n in [0, 1, 5, 300, 3000]:
        for _ in range(12):
            text = "".join(rng.choices(BITS, k=n))
            tree = CountTree(enc, text)
            assert tree.tokens == full(enc, text) and tree.text() == text
            for _ in range(15):
                start, removed = rng.randint(-2, len(text) + 2), rng.choice([0, 1, 2, 30, 700, len(text)])
                inserted = "".join(rng.choices(BITS, k=rng.choice([0, 1, 3, 400])))
                at = min(max(start, 0), len(text))
                text = text[:at] + inserted + text[min(at + removed, len(text)):]
                tree.edit(start, removed, inserted)
                assert (tree.text(), tree.tokens, tree.length) == (text, full(enc, text), len(text))


def test_only_touched_regions_are_encoded_again(words):
    rng, enc = random.Random(1), Encoder(PATH)
    text = " ".join(rng.choices(words, k=200_000))
    tree = CountTree(enc, text)
    tree.encoded = 0
    for _ in range(20):
        tree.edit(rng.randrange(tree.length), 3, "xyz")
    assert tree.encoded < 20 * 4 * (LEAF + 20)


def test_rows(spark, words):
    rows = [(1, " ".join(words), [(5, 3, "new"), (0, 0, " ")], "x"), (2, None, [(0, 1, "a b")], "x"), (3, "", [], None), (None, "a b", None, None), (4, "abc", [None, (None, 2, None)], "x"), (4, "abc", [None, (None, 2, None)], "x"),
            (5, "one  two", [(99, 5, " three"), (-4, 1, "")], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start: int, removed: int, inserted: string>>, body string")
    got = counted(df, PATH)
    assert got.columns == ["doc_id", "body", "n_tokens", "edited_tokens", "edited_chars", "reencoded"]
    enc = Encoder(PATH)
    want = []
    for doc_id, text, edits, body in rows:
        after = text or ""
        for e in edits or []:
            if e:
                at = min(max(e[0] or 0, 0), len(after))
                after = after[:at] + (e[2] or "") + after[at + (e[1] or 0):]
        want.append((doc_id, body, full(enc, text or ""), full(enc, after), len(after)))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert counted(df.limit(0), PATH).count() == 0


def test_digest_against_full_encodings(spark, data):
    docs, enc = spark.read.parquet(f"{data}/documents.parquet"), Encoder(PATH)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = digest(docs, PATH).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id]
        n, a = len(text), len(text) // 3
        after = "new " + text[:a] + text[:12] + text[a + 20 :] + "\n"
        after = after[: n // 2] + after[n // 2 + 1 :]
        assert (r.n_tokens, r.edited_tokens, r.edited_chars) == (full(enc, text), full(enc, after), len(after))
