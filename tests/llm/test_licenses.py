import math
import random
import re
from collections import Counter

import pytest

from pitwall.llm import licenses
from pitwall.llm.licenses import TEMPLATES, _words, scanned

FILES = "doc_id long, path string, text string, license string, word string, t string, folder string"


def brute(files, threshold):
    n = len(files)
    vocabulary = {w for _, b in TEMPLATES for w in _words(b)}
    seen = Counter(w for f in files for w in set(_words(f[2] or "")) & vocabulary)

    def idf(w):
        return math.log((1 + n) / (1 + seen[w])) + 1 if w in vocabulary else math.log(1 + n) + 1

    def vector(words):
        raw = {w: k * idf(w) for w, k in Counter(words).items()}
        size = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / size for w, x in raw.items()}

    templates = [(name, vector(_words(b))) for name, b in TEMPLATES]
    own = {}
    for f in files:
        text = f[2] or ""
        blocks = re.split(r"\r\n|\r|\n", text) + re.split(r"(?:\r\n|\r|\n)[\t\v\f ]*(?:\r\n|\r|\n)", text)
        for b in blocks:
            if _words(b):
                v = vector(_words(b))
                for name, t in templates:
                    score = round(min(sum(x * t.get(w, 0) for w, x in v.items()), 1.0), 6)
                    if score >= threshold:
                        own[f[:3]] = min(own.get(f[:3], (0, "")), (-score, name))
    speaking = {}
    for f, (s, name) in own.items():
        if f[1] is not None and re.search(licenses.LICENSE_FILE, f[1].rsplit("/", 1)[-1]):
            folder = f[1].rpartition("/")[0]
            speaking[folder] = min(speaking.get(folder, (0, "")), (s, name))
    out = []
    for f in files:
        if f[:3] in own:
            out.append((f[0], f[1], own[f[:3]][1], -own[f[:3]][0], "declared", None))
            continue
        folder, found = (f[1].rpartition("/")[0] if f[1] is not None else None), None
        while folder is not None and found is None:
            found = folder if folder in speaking else None
            folder = folder.rpartition("/")[0] if folder else None
        out.append((f[0], f[1], speaking[found][1] if found is not None else None, None, "inherited" if found is not None else None, found))
    return sorted(out, key=repr)


def tree(words, n=250):
    rng, files = random.Random(9), []
    for i in range(n):
        folder = "/".join(rng.choice("abc") for _ in range(rng.randint(0, 4)))
        name = rng.choice(["LICENSE", "Licence.md", "COPYING"]) if rng.random() < 0.12 else f"f{i}.txt"
        lines = [" ".join(rng.choices(words + ["the", "license", "under", "version"], k=rng.randint(1, 12))) for _ in range(rng.randint(0, 6))]
        if rng.random() < (0.8 if not name.startswith("f") else 0.1):
            notice = rng.choice(TEMPLATES)[1].split()
            if rng.random() < 0.5:
                notice.insert(rng.randrange(len(notice)), rng.choice(words))
            lines.insert(rng.randint(0, len(lines)), rng.choice([" ".join(notice), "\n\n" + " ".join(notice[:4]) + "\n" + " ".join(notice[4:]) + "\n\n", "# " + " ".join(notice).upper()]))
        files.append((i, (folder + "/" if folder else "") + name, rng.choice(["\n", "\r\n"]).join(lines), "x", "y", "z", "w"))
    files += [(900, None, "Released under the MIT License.", *"xyzw"), (901, None, None, *"xyzw"), (902, "a/b/none.txt", None, *"xyzw"), (903, "a/empty", "", *"xyzw"), (904, "a/b/c/long.txt", "word license " * 20_000, *"xyzw"),
              files[0], (905, "deep/" * 30 + "x.txt", "nothing", *"xyzw"), (906, "deep/LICENSE", "Released under the MIT License.", *"xyzw")]
    return files


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_against_brute_force(spark, words, threshold):
    files = tree(words)
    got = scanned(spark.createDataFrame(files, FILES), threshold=threshold, keep=["doc_id"])
    assert got.columns == ["doc_id", "path", "license", "score", "origin", "from_folder"]
    rows = [tuple(r) for r in got.collect()]
    want = brute(files, threshold)
    assert sorted(rows, key=repr) == want
    assert len({r[2] for r in want}) > 4 and {r[4] for r in want} == {"declared", "inherited", None}


def test_empty_table_and_plan(spark, words):
    empty = spark.createDataFrame([], FILES)
    assert scanned(empty, keep=["doc_id"]).count() == 0
    plan = scanned(spark.createDataFrame(tree(words, 20), FILES))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian", plan)


def test_common_words_weigh_little(spark):
    """A notice among words that nearly all files hold is found by the query, with the score of a brute force that counts all words."""
    notice = "Released under the MIT License. about there again once"
    docs = [(i, "about there again once " + f"word{i}", "src") for i in range(300)] + [(300, notice, "src"), (301, "Released under the MIT License. odd rarity strange unseen", "src")]
    seen = Counter(w for _, text, _ in docs for w in set(_words(text)))

    def vector(text):
        raw = {w: k * (math.log((1 + len(docs)) / (1 + seen[w])) + 1) for w, k in Counter(_words(text)).items()}
        size = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / size for w, x in raw.items()}

    v, t = vector(notice), vector("Released under the MIT License.")
    want = round(sum(x * t.get(w, 0) for w, x in v.items()), 6)
    got = {r.doc_id: (r.license, r.score) for r in licenses.digest(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert want > 0.8 and got[300] == ("MIT", want)
    assert got[301] == got[0] == (None, None)


def test_headers_files_and_variants(spark):
    """Headers, file openings, SPDX lines and near variants get their own license; an identifier outside the list gets none."""
    want = {
        "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Everyone": "GPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007": "AGPL-3.0",
        "Apache License\nVersion 2.0, January 2004": "Apache-2.0", "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0", "This work is licensed under the GNU General Public License.": "GPL-1.0-or-later",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International": "CC-BY-SA-4.0", "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,\nprovided that the above copyright notice and this permission notice appear in all copies.": "ISC",
        "BSD 2-Clause License\n\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": "BSD-2-Clause",
        "# SPDX-License-Identifier: MIT": "MIT", "The MIT License (MIT)": "MIT", "// SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0", "/* SPDX-License-Identifier: LGPL-3.0-only */": "LGPL-3.0", "SPDX-License-Identifier: Frob-2.0": None,
    }
    docs = [(i, text, "src") for i, text in enumerate(want, 1)] + [(i, f"plain prose {i}", "src") for i in range(100, 140)]
    got = {r.doc_id: r.license for r in licenses.digest(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert {text: got[i] for i, text in enumerate(want, 1)} == want and not any(got[i] for i in range(100, 140))
