import random
import re

import pytest

from pitwall.llm import decontaminate

GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, words string, t string, item_id long"
ITEMS = "item_id long, text string, words string"


def words_of(text):
    return [w for w in GAP.split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]


def brute(docs, items, k=10):
    out = []
    for doc_id, text, *_ in docs:
        words, hit, ids = words_of(text), set(), set()
        for item_id, body, *_ in items:
            w = words_of(body)
            for win in ([w[i : i + k] for i in range(len(w) - k + 1)] or [w]) if w else []:
                for s in range(len(words) - len(win) + 1):
                    if words[s : s + len(win)] == win:
                        hit |= set(range(s, s + len(win)))
                        ids |= {str(item_id)} if item_id is not None else set()
        out.append((doc_id, len(words), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=repr)


def cases(words):
    rng = random.Random(11)
    items = [(i, " ".join(rng.choices(words[:60], k=rng.choice([2, 9, 10, 11, 30]))).title(), "x") for i in range(25)]
    items += [(100, None, None), (101, "", None), (102, "...", None), (None, " ".join(words[100:112]), None), (7, " ".join(words[120:135]), None), (103, "zebra!", None), (104, "  ÉTÉ  ñandú ", None)]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += rng.choices(words[:60], k=rng.choice([1, 8, 30]))
            body = words_of(rng.choice(items)[1])
            cut = rng.choice([0, 0, 1, 3])
            parts += body[cut:] if rng.random() < 0.7 else body[: rng.choice([9, 10, 12])]
        docs.append((i, rng.choice([" ", ", ", "\n- "]).join(parts), "en", None, None, None))
    docs += [(None, " ".join(words[100:112]), None, None, None, None), (500, None, None, None, None, None), (501, "", None, None, None, None), (502, "Zebra", None, None, None, None), (502, "Zebra", None, None, None, None),
             (502, "zebras", None, None, None, None), (503, "ÉTÉ ñandú", None, None, None, None), (504, "(" + "zebra-" * 3000, None, None, None, None)]
    return docs, items


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_against_brute_force(spark, words, monkeypatch, bits):
    monkeypatch.setattr(decontaminate, "LEAST_BITS", bits)
    monkeypatch.setattr(decontaminate, "MOST_BITS", bits)
    docs, items = cases(words)
    got = decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got), key=repr) == brute(docs, items)


def test_clean_rows_stay_as_they_are(spark, words):
    docs, items = cases(words)
    got = decontaminate.clean(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    bad = {(a, b) for (a, b, *_), r in zip(docs, [brute([d], items)[0] for d in docs]) if r[4]}
    assert got.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((d for d in docs if (d[0], d[1]) not in bad), key=repr)


def test_empty_tables(spark, words):
    docs, items = cases(words)
    none, some = spark.createDataFrame([], ITEMS), spark.createDataFrame(docs, DOCS)
    assert not any(r.contaminated for r in decontaminate.contamination(some, none).collect())
    assert decontaminate.clean(some, none).count() == len(docs)
    assert decontaminate.digest(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0


def test_no_python_in_the_plan(spark, words):
    docs, items = cases(words)
    plan = decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
