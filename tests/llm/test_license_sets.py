"""SPDX expressions, several licenses in a sentence, notices inside longer lines, and the query's own setting against brute force."""

import math
import random
import re
from collections import Counter

import pytest

from pitwall.llm import licenses
from pitwall.llm.license_texts import SPDX
from pitwall.llm.licenses import TEMPLATES, _words, digest, scanned

DOCS = "doc_id long, text string, source string"
FILES = "doc_id long, path string, text string"


def told(spark, texts):
    docs = [(i, t, "src") for i, t in enumerate(texts, 1)] + [(i, f"plain prose {i}", "src") for i in range(1000, 1040)]
    got = {r.doc_id: (r.license, r.licenses) for r in digest(spark.createDataFrame(docs, DOCS)).collect()}
    assert all(got[i] == (None, "") or got[i] == (None, None) for i in range(1000, 1040))
    return [got[i] for i in range(1, len(texts) + 1)]


def test_expressions(spark):
    want = {
        "SPDX-License-Identifier: MIT OR Apache-2.0": ("MIT OR Apache-2.0", "Apache-2.0|MIT"),
        "# SPDX-License-Identifier:  MIT   AND BSD-3-Clause  ": ("MIT AND BSD-3-Clause", "BSD-3-Clause|MIT"),
        "/* SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0) */": ("GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0"),
        "// SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception\ncode": ("Apache-2.0 WITH LLVM-exception", "Apache-2.0"),
        "<!-- SPDX-License-Identifier: MIT OR Frob-9 -->": ("MIT OR Frob-9", "MIT"),
        "SPDX-License-Identifier: ISC And so on": (None, None),
        "SPDX-License-Identifier: (MIT OR ISC) AND GPL-3.0+": ("(MIT OR ISC) AND GPL-3.0+", "GPL-3.0|ISC|MIT"),
        "SPDX-License-Identifier: MIT OR ISC\nmore\nSPDX-License-Identifier: Zlib AND ISC": ("(MIT OR ISC) AND (Zlib AND ISC)", "ISC|MIT|Zlib"),
        "SPDX-License-Identifier: MIT": ("MIT", "MIT"),
    }
    assert told(spark, list(want)) == list(want.values())
    # an expression without a known license says nothing by itself
    assert told(spark, ["SPDX-License-Identifier: Frob-1 OR Grob-2"])[0][0] is None


def test_several_licenses_in_a_sentence(spark):
    got = told(spark, ["This project is dual licensed under the MIT License and the Apache License, Version 2.0", "Licensed under the MIT License or the Mozilla Public License Version 2.0.", "Released under the MIT License."])
    assert [g[1] for g in got] == ["Apache-2.0|MIT", "MIT|MPL-2.0", "MIT"]


def test_notices_inside_longer_lines(spark, words):
    rng, texts, names = random.Random(2), [], []
    notices = [("MIT", "Released under the MIT License."), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
               ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."), ("MPL-2.0", "Licensed under the Mozilla Public License Version 2.0."), ("BSD-2-Clause", "Licensed under the BSD 2-Clause License.")]
    for _ in range(60):
        name, notice = rng.choice(notices)
        before, after = (" ".join(rng.choices(words, k=rng.randint(4, 25))).capitalize() for _ in range(2))
        texts.append(f"Copyright (c) 2020 Foo Bar. {before}. {notice} All rights reserved by {after}.")
        names.append(name)
    docs = [(i, f"a/f{i}", t) for i, t in enumerate(texts)] + [(i, f"a/f{i}", f"plain prose {i}") for i in range(1000, 1040)]
    rows = {r.doc_id: r.license for r in scanned(spark.createDataFrame(docs, FILES), licenses.TEMPLATES + licenses.FORMS, keep=["doc_id"], every_word=True, inline=True).collect()}
    assert not any(rows[i] for i in range(1000, 1040))
    got = [(rows[i],) for i in range(len(texts))]
    recall = sum(g[0] == n for g, n in zip(got, names)) / len(names)
    print("recall of inline notices", recall)
    assert recall >= 0.9


def brute(texts, templates, exact, threshold, inline):
    """The query's own setting: all words counted over all files, SPDX lines with all their words, lines and paragraphs and, if asked for, sentences of lines; parts only where those of one are of different licenses."""
    n, seen = len(texts), Counter(w for t in texts for w in set(_words(t or "")))

    def vector(body):
        raw = {w: k * (math.log((1 + n) / (1 + seen[w])) + 1) for w, k in Counter(_words(body)).items()}
        size = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / size for w, x in raw.items()} if size else {}

    known = [(name, vector(b), len(set(_words(b))) if (name, b) in exact else 0) for name, b in (*templates, *exact)]
    def likest(b):
        v, best = vector(b), (0, "")
        for name, template, least in known:
            score = round(min(sum(x * template.get(w, 0) for w, x in v.items()), 1.0), 6)
            if score >= threshold and sum(w in template for w in v) >= least:
                best = min(best, (-score, name))
        return best

    out = []
    for t in texts:
        lines = re.split(r"\r\n|\r|\n", t or "")
        blocks = lines + re.split(r"(?:\r\n|\r|\n)[\t\v\f ]*(?:\r\n|\r|\n)", t or "")
        sentences = [s for l in lines for s in (re.split(r"(?<=[.;!?])[\t ]+", l) if inline else [l])]
        found = [likest(b) for b in blocks + sentences * inline]
        for s in sentences:
            parts = [likest(p) for p in re.split(r"(?i),?[\t ]+(?:and|or|and/or)[\t ]+", s) if p != s]
            found += parts if len({p[1] for p in parts} - {""}) > 1 else []
        best = min(found)
        names = {f[1] for f in found if f in parts_of(sentences, likest)} if best[1] else set()
        out.append((best[1] or None, -best[0] if best[1] else None, sorted(names | {best[1]}) if best[1] else None))
    return out


def parts_of(sentences, likest):
    out = []
    for s in sentences:
        parts = [likest(p) for p in re.split(r"(?i),?[\t ]+(?:and|or|and/or)[\t ]+", s) if p != s]
        out += [p for p in parts if p[1]] if len({p[1] for p in parts} - {""}) > 1 else []
    return out


@pytest.mark.parametrize("inline", [False, True])
def test_query_setting_against_brute_force(spark, words, inline):
    rng, texts, exact = random.Random(4), [], SPDX[:12]
    for _ in range(150):
        lines = [" ".join(rng.choices(words + ["license", "the", "under"], k=rng.randint(1, 10))) for _ in range(rng.randint(0, 4))]
        if rng.random() < 0.6:
            notice = rng.choice([b for _, b in TEMPLATES] + [b for _, b in exact])
            lines.insert(rng.randint(0, len(lines)), rng.choice([notice, "# " + notice, f"Some words. {notice} And more here.", notice.replace(" ", "\n", 1), f"{notice[:-1]} or {rng.choice(TEMPLATES)[1]}"]))
        texts.append("\n".join(lines) if rng.random() < 0.97 else None)
    df = spark.createDataFrame([(i, f"a/f{i}", t) for i, t in enumerate(texts)], FILES).repartition(3)
    got = {r.doc_id: (r.license, r.score, r.licenses) for r in scanned(df, keep=["doc_id"], every_word=True, exact=exact, several=True, inline=inline).collect()}
    want = brute(texts, TEMPLATES, exact, 0.8, inline)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[0] is not None for w in want) > 50 and licenses.LICENSE_FILE
