import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pitwall.llm import encoder, token_files
from pitwall.llm.encoder import Encoder, safe_cuts
from pitwall.sources.scratch import scratch_path

tokenizers = pytest.importorskip("public_tokenizers")
PATH = tokenizers.path("byte_bpe_50k.json")

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n b", "a\n\n  b ", "\t \t", "it's  we'll", "x<|endoftext|> y", "日本語 テキスト", "émile  b", "a᠎ b", "²³ Ⅷ½", "a\x1c b\x1d c",
       "   x", "##&& $$ a,b.c", "a\r\n b", "123 456abc", "😀 😀😀", "'s 't", "word" * 40 + " end"]


def test_pieces_encode_like_the_tokenizer(words):
    rng, enc = random.Random(2), Encoder(PATH)
    texts = ODD + ["".join(rng.choice(["a", "B", " ", "  ", "\n", "\t", "é", "1", "'s", ".", " ", "᠎", "<|endoftext|>", "\x85"]) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for t in texts:
        assert np.frombuffer(enc.encode(t), enc.dtype).tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
        assert "".join(safe_cuts(t)) == t


@pytest.mark.parametrize("run", [1, 60, 1 << 22])
def test_runs_encode_like_the_tokenizer(words, monkeypatch, run):
    monkeypatch.setattr(encoder, "RUN", run)
    rng, enc = random.Random(4), Encoder(PATH)
    texts = ODD + [" ".join(rng.choices(words + ["end.", "(a", "1,", "a.\nB", "x  y", "<|endoftext|>", ""], k=rng.randint(0, 40))) for _ in range(200)]
    want = [[*enc.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts[3:]]
    got = list(enc.runs(pa.array(texts)[3:], 2))
    assert [n for _, lengths in got for n in lengths] == [len(w) for w in want]
    assert [i for ids, _ in got for i in ids] == [i for w in want for i in w]
    assert all(ids.dtype == enc.dtype for ids, _ in got) and (len(got) == 1) == (run == 1 << 22)
    assert list(enc.runs(pa.array([], pa.string()), 2)) == []


def test_a_run_looks_up_each_word_once(words):
    enc, asked = Encoder(PATH), []

    class Asked(type(enc.words)):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    enc.words = Asked(enc)
    texts = [" ".join(random.Random(i).choices(words, k=500)) for i in range(50)]
    (ids, lengths), = enc.runs(pa.array(texts), 2)
    assert len(ids) == sum(lengths) and len(asked) <= len(words)


def test_round_trip(spark, words):
    rng = random.Random(5)
    texts = [None, *ODD, *(" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(150))]
    ids = [3 * i - 100 for i in range(len(texts))]
    ids[3] = ids[9] = None
    ids[20] = ids[21]
    rows = list(zip(ids, texts, ["clash"] * len(ids)))
    rng.shuffle(rows)
    root = scratch_path(spark, "tokens")
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5), root, PATH, 2)
    got = sorted(map(tuple, token_files.documents(spark, root, with_ids=True).collect()), key=lambda r: r[1])
    tok, start = Encoder(PATH).tokenizer, 0
    for (doc_id, text, _), r in zip(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), got):
        want = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        assert r == (doc_id, start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()), want)
        start += len(want)
    assert len(got) == len(rows)
    assert token_files.manifest(spark, root).agg({"n_tokens": "sum"}).first()[0] == start


def test_empty_table(spark):
    root = scratch_path(spark, "tokens")
    token_files.write(spark.createDataFrame([], "doc_id long, text string"), root, PATH, 2)
    assert token_files.documents(spark, root).count() == 0


def test_shards_span_several_partitions(spark, data):
    root = scratch_path(spark, "tokens")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    token_files.write(docs, root, PATH, 2)
    rows = token_files.documents(spark, root).orderBy("doc_id").collect()
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows])[:-1])
    assert len(rows) == docs.count()
