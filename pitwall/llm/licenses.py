"""License scans: sparse TF-IDF cosine of text blocks to templates, and inheritance from the nearest ancestor folder; DataFrame functions only."""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitwall.llm.columns import plain_words
from pitwall.llm.license_texts import FORMS, SPDX
from pitwall.sources.scratch import staged

# notices, headers and openings of license files
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal."),
    ("GPL-2.0", "This program is free software; you can redistribute it under the terms of the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *FORMS,
)
#: Files that speak for their folder and all below it.
LICENSE_FILE = r"(?i)^(un)?(licen[cs]e|copying|notice)([._-].*)?$"
_GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _words(text: str) -> list[str]:
    return [w for w in _GAP.split("".join(c.lower() if c.isascii() else c for c in text)) if w]


def files_with(files: DataFrame, text: str = "text") -> DataFrame:
    """Rows (word, n): for each word of the texts the number of files that hold it, and under "" the number of files."""
    return files.select(F.explode(F.array_append(F.array_distinct(plain_words(F.col(f"`{text}`"))), F.lit(""))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def needed_words(vector: dict[str, float], threshold: float, files: dict[str, int]) -> set[str]:
    """Words of a unit vector without which no text reaches the threshold, as the rest alone is too short: those that are in few files for their weight."""
    need, rest = set(), 1.0
    for word, weight in sorted(vector.items(), key=lambda x: ((1 + files.get(x[0], 0)) / (x[1] * x[1]), x[0])):
        if rest < threshold * threshold:
            break
        need.add(word)
        rest -= weight * weight
    return need


def _small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def declared(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.8, path: str = "path", text: str = "text", every_word: bool = False, exact: tuple[tuple[str, str], ...] = (), several: bool = False, inline: bool = False) -> DataFrame:
    """Rows (path, t, license, score) for the files with a block that is like a template: the likest license, of equals the first by name.

    Blocks are the lines of a text and its paragraphs of several lines. A block's vector has its words' counts times their inverse frequency over all
    files, ln((1 + files) / (1 + files with the word)) + 1; unless `every_word`, words outside the templates weigh as words seen nowhere. Only texts
    with a word that some template can't do without are cut into blocks. t is a hash of the text. A template of `exact` counts only
    for blocks with all its words.

    With `inline`, the sentences of a line are blocks too, so a notice is found among other words of one line, however rare those are. With `several`, rows also
    have `licenses`, names in order: where the parts of a line (with `inline`, of a sentence) around `and` and `or` are like templates of different licenses, the
    file has all of them, besides the likest. An SPDX line with AND, OR or WITH and a known identifier goes before all likeness: its license is the expression, with score 1, and its
    licenses are the known ones in it. Several such lines are taken together.
    """
    whole, templates = len(templates), (*templates, *exact)
    vocabulary = sorted({w for _, body in templates for w in _words(body)})
    counts = staged(files_with(files, text), "frequencies")
    known = {r["word"]: r["n"] for r in counts.filter(F.col("word").isin(["", *vocabulary])).collect()}
    total = known.pop("", 0)
    idf = {w: math.log((1 + total) / (1 + known.get(w, 0))) + 1 for w in vocabulary}
    vectors, needs = [], []
    for name, body in templates:
        raw = {w: n * idf[w] for w, n in Counter(_words(body)).items()}
        size = math.sqrt(sum(x * x for x in raw.values()))
        vectors.append((name, {w: x / size for w, x in raw.items()}))
        # a score is rounded to six digits
        needs.append(needed_words(vectors[-1][1], threshold - 1e-6, known))
    # both are as long as the templates, which the caller holds in memory
    rows = [{"template": i, "license": name, "word": w, "weight": x, "need": w in needs[i], "least": len(v) if i >= whole else 0} for i, (name, v) in enumerate(vectors) for w, x in v.items()]
    weights = _small_table(files.sparkSession, rows, "template int, license string, word string, weight double, need boolean, least int")
    body, needed = F.col(f"`{text}`"), F.lit(sorted(set().union(*needs)))
    chosen = files.filter(F.arrays_overlap(plain_words(body), needed)).select(F.col(f"`{path}`").alias("path"), F.xxhash64(body).alias("t"), body.alias("text")).withColumn("row", F.monotonically_increasing_id())
    lines = F.split("text", r"\r\n|\r|\n")
    paragraphs = F.filter(F.split("text", r"(?:\r\n|\r|\n)[\x09\x0B\x0C\x20]*(?:\r\n|\r|\n)"), lambda p: p.rlike(r"[\r\n]"))
    cuts = F.transform(F.concat(lines, paragraphs), lambda b: _block(b))
    if several or inline:
        cuts = F.concat(cuts, _inner_blocks(lines, needed, several, inline))
    blocks = chosen.select("path", "t", "row", F.posexplode(cuts).alias("block", "b")).select("path", "t", "row", "block", "b.sentence", plain_words(F.col("b.body")).alias("words"))
    terms = blocks.filter(F.arrays_overlap("words", needed)).select("path", "t", "row", "block", "sentence", F.explode("words").alias("word")).groupBy("path", "t", "row", "block", "sentence", "word").agg(F.count("*").alias("n"))
    terms = staged(terms, "terms")
    # words that a thousandth of the files hold are few and may fill most blocks, so they stay out of the join by word
    counts = counts if every_word else counts.filter(F.col("word").isin(vocabulary))
    common = F.col("n") * 1000 >= total
    met = terms.withColumnRenamed("n", "times").join(F.broadcast(counts.filter(common)), "word", "left")
    rest = met.filter("n is null").drop("n").join(counts.filter(~common), "word", "left")
    terms = staged(met.filter("n is not null").unionByName(rest).withColumn("x", F.col("times") * (F.log((1 + F.lit(total)) / (1 + F.coalesce("n", F.lit(0)))) + 1)), "weighted")
    key = ["row", "block"]
    sizes = terms.groupBy(*key).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("size"))
    # a block meets only templates of which it has a needed word
    pairs = terms.join(F.broadcast(weights.filter("need").select("word", "template")), "word").select(*key, "template").distinct()
    known_terms = terms.join(F.broadcast(weights.select("word").distinct()), "word", "left_semi")
    dots = known_terms.join(pairs, key).join(F.broadcast(weights), ["template", "word"]).groupBy("path", "t", *key, "template", "license").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"), (F.count("*") >= F.max("least")).alias("enough"))
    # rounded, so that the order in which parts are summed doesn't decide what is like enough
    scores = dots.join(sizes, key).withColumn("score", F.round(F.least(F.col("dot") / F.col("size"), F.lit(1.0)), 6)).filter((F.col("score") >= threshold) & F.col("enough"))
    like = F.struct((-F.col("score")).alias("s"), "license")
    if not several:
        best = scores.groupBy("path", "t").agg(F.min(like).alias("best"))
        return best.select("path", "t", F.col("best.license").alias("license"), (-F.col("best.s")).alias("score"))
    # parts count where those of one line or sentence are of different licenses
    parts = terms.filter("sentence is not null").select(*key, "sentence").distinct()
    of_part = scores.join(parts, key).groupBy("path", "t", *key, "sentence").agg(F.min(like).alias("best"))
    of_sentence = of_part.groupBy("path", "t", "row", "sentence").agg(F.collect_set("best.license").alias("names"), F.min("best").alias("best")).filter(F.size("names") > 1)
    whole_scores = scores.join(parts, key, "left_anti")
    found = whole_scores.select("path", "t", like.alias("best"), F.array().cast("array<string>").alias("names")).union(of_sentence.select("path", "t", "best", "names"))
    told = found.groupBy("path", "t").agg(F.min("best").alias("best"), F.flatten(F.collect_set("names")).alias("names"))
    told = told.select("path", "t", F.col("best.license").alias("license"), (-F.col("best.s")).alias("score"), F.array_sort(F.array_distinct(F.array_append("names", F.col("best.license")))).alias("licenses"))
    stated = expressions(files, path, text)
    return stated.unionByName(told.alias("o").join(stated.alias("e"), F.col("o.path").eqNullSafe(F.col("e.path")) & (F.col("o.t") == F.col("e.t")), "left_anti"))


def _block(body: Column, sentence: Column | None = None) -> Column:
    return F.struct(body.alias("body"), (F.lit(None).cast("int") if sentence is None else sentence).alias("sentence"))


def _inner_blocks(lines: Column, needed: Column, several: bool, inline: bool) -> Column:
    """Sentences of lines that have several (`inline`), and parts of lines or sentences that have several (`several`), as one array; parts know what they are of. Only
    lines with a needed word count."""
    held = F.filter(lines, lambda l: F.arrays_overlap(plain_words(l), needed))
    whole = F.flatten(F.transform(held, lambda l: F.split(l, r"(?<=[.;!?])[\x09\x20]+"))) if inline else held
    parts = F.flatten(F.transform(whole, lambda s, i: F.transform(F.split(s, r"(?i),?[\x09\x20]+(?:and|or|and/or)[\x09\x20]+"), lambda p: _block(p, i))))
    out = F.transform(whole, lambda s: _block(s)) if inline else F.array().cast("array<struct<body:string,sentence:int>>")
    return F.concat(out, F.filter(parts, lambda p: p["body"] != F.get(whole, p["sentence"]))) if several else out


_ID = r"\(*[A-Za-z0-9.+:-]*[A-Za-z0-9+]\)*"
#: Identifiers joined by operators, which are in capitals.
_EXPRESSION = rf"SPDX-License-Identifier:[\x09\x20]*({_ID}(?:[\x09\x20]+(?:AND|OR|WITH)[\x09\x20]+{_ID})+)"


def expressions(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Rows (path, t, license, score, licenses) of the files with an SPDX line that joins identifiers by AND, OR or WITH, one of them known at least: the expression
    with single blanks, those of several lines joined by ` AND ` in order, and the known licenses in order. The identifier after WITH is an exception, not a license.
    """
    known = {i.split(": ")[1].lower(): name for name, i in SPDX}
    body = F.col(f"`{text}`")
    found = files.filter(body.contains("SPDX-License-Identifier") & body.rlike(_EXPRESSION)).select(F.col(f"`{path}`").alias("path"), F.xxhash64(body).alias("t"), F.regexp_extract_all(body, F.lit(_EXPRESSION), 1).alias("all"))
    # brackets around the whole say nothing
    plain = F.transform("all", lambda e: F.regexp_replace(F.regexp_replace(e, r"[\x09\x20]+", " "), r"^\(([^()]*)\)$", "$1"))
    ids = F.flatten(F.transform("plain", lambda e: F.split(F.regexp_replace(F.lower(e), r"with [a-z0-9.+:-]+", ""), r"[ ()]+")))
    names = F.map_from_arrays(F.lit(list(known)), F.lit(list(known.values())))
    licenses = F.array_sort(F.array_distinct(F.array_compact(F.transform("ids", lambda i: F.try_element_at(names, F.regexp_replace(i, r"\+$", ""))))))
    rows = found.withColumn("plain", F.array_distinct(plain)).withColumn("ids", ids).withColumn("licenses", licenses).filter(F.size("licenses") > 0)
    joined = F.when(F.size("plain") == 1, F.get("plain", 0)).otherwise(F.array_join(F.transform(F.array_sort("plain"), lambda e: F.concat(F.lit("("), e, F.lit(")"))), " AND "))
    return rows.select("path", "t", joined.alias("license"), F.lit(1.0).alias("score"), "licenses").distinct()


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def inherited(folders: DataFrame, licensed: DataFrame) -> DataFrame:
    """For different rows (folder) the license of the nearest ancestor, itself included: (folder, license, from_folder). licensed: (folder, license), one row each.

    Every folder is joined by each of its ancestors' paths; the deepest match stays. Work is by folder, not by file.
    """
    parts = F.split("folder", "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(F.array_join(F.slice(parts, 1, i), "/").alias("up"), i.alias("depth")))
    above = folders.select("folder", F.explode(ups).alias("a")).select("folder", "a.up", "a.depth").distinct()
    found = above.join(licensed.select(F.col("folder").alias("up"), "license"), "up")
    return found.groupBy("folder").agg(F.max(F.struct("depth", "up", "license")).alias("m")).select("folder", F.col("m.license").alias("license"), F.col("m.up").alias("from_folder"))


def scanned(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.8, path: str = "path", text: str = "text", keep: list[str] | None = None, every_word: bool = False, exact: tuple[tuple[str, str], ...] = (), several: bool = False, inline: bool = False) -> DataFrame:
    """One row per row of `files`: the columns `keep`, path, license, score, origin and from_folder; with `several` also licenses, all of a text's own (see `declared`),
    null where the text declares none.

    origin is `declared` where the text itself is like a template, else `inherited` from the license file of the nearest folder above (score null),
    else null. A folder with several license files takes the likest, of equals the first by name. Null and empty texts declare nothing; a null path
    inherits nothing. Rows alike in path and text get alike results. Paths have slashes; one without is in the root folder "".
    """
    own = staged(declared(files, templates, threshold, path, text, every_word, exact, several, inline), "declared")
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    speaking = own.filter(F.col("path").isNotNull() & name.rlike(LICENSE_FILE)).groupBy(_folder(F.col("path")).alias("folder")).agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("m"))
    licensed = staged(speaking.select("folder", F.col("m.license").alias("license")), "folders")
    keep = keep or []
    rows = files.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{path}`").alias("path"), F.xxhash64(F.col(f"`{text}`")).alias("t")).withColumn("folder", _folder(F.col("path")))
    above = inherited(rows.select("folder").filter("folder is not null").distinct(), licensed)
    o, a = own.alias("o"), above.alias("a")
    out = rows.alias("r").join(o, F.col("r.path").eqNullSafe(F.col("o.path")) & (F.col("r.t") == F.col("o.t")), "left").join(a, F.col("r.folder") == F.col("a.folder"), "left")
    return out.select(*(F.col(f"r.`{c}`") for c in keep), F.col("r.path").alias("path"), F.coalesce("o.license", "a.license").alias("license"), F.col("o.score").alias("score"),
                      F.when(F.col("o.license").isNotNull(), F.lit("declared")).when(F.col("a.license").isNotNull(), F.lit("inherited")).alias("origin"),
                      F.when(F.col("o.license").isNull(), F.col("a.from_folder")).alias("from_folder"), *([F.col("o.licenses")] if several else []))


def as_files(docs: DataFrame) -> DataFrame:
    """The documents as files of a tree: a folder per source, with groups of 2,048 ids, with folders of 64; the first id of each is its license file."""
    group, folder, n = F.expr("doc_id div 2048"), F.expr("pmod(doc_id, 2048) div 64"), F.col("doc_id")
    source = F.coalesce("source", F.lit("unknown"))
    path = (F.when(n.isNull(), F.lit(None).cast("string")).when(F.pmod(n, F.lit(2048)) == 0, F.concat(source, F.lit("/g"), group, F.lit("/LICENSE")))
            .when(F.pmod(n, F.lit(64)) == 0, F.concat(source, F.lit("/g"), group, F.lit("/d"), folder, F.lit("/LICENSE"))).otherwise(F.concat(source, F.lit("/g"), group, F.lit("/d"), folder, F.lit("/"), n, F.lit(".txt"))))
    return docs.select("doc_id", path.alias("path"), "text")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, path, license, score, origin, from_folder, licenses (joined by a bar)."""
    rows = scanned(as_files(docs), keep=["doc_id"], every_word=True, exact=SPDX, several=True)
    return rows.withColumn("licenses", F.array_join("licenses", "|"))
