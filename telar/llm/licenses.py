"""Licence scans: a trained paragraph classifier, confirmed by template comparison.

A paragraph is a line of a text, or a run of its lines without an empty one
between them (a line of comment marks alone is empty): all runs are looked at
that can hold a template, however it is wrapped. Features are the word 1- to 3-grams
(lower case, each number as 0) that occur in the templates, but for those of common words alone. A multinomial
logistic regression with sparse weights (proximal gradient, L1) gives each
licence family and the class ``unknown`` a probability; a temperature fitted on
notices that are worded otherwise than the training texts calibrates them. A
paragraph has the likeliest family if that is not ``unknown`` and reaches
``MIN_PROBABILITY``, and the family is confirmed if the paragraph holds at least
``MIN_OVERLAP`` of the n-grams of one of the family's templates. Training sees the
texts below alone and takes about a second on the driver; scoring uses DataFrame
functions only.

Most paragraphs need no sums: the trained weights themselves tell that no family
reaches ``MIN_PROBABILITY`` in a paragraph with at most one of the words that carry
weight, but for a few words that suffice alone (``telling``). Such paragraphs are
``unknown``; the others meet the weights in a broadcast join of fixed size.

Of confirmed paragraphs that overlap and have one family, or of which one holds
the other, the one with the larger overlap stays, then the shorter, then the
first. A line within a paragraph that stays is not counted again.

Defined cases: null and empty texts have no paragraphs; rows with equal ids are
one document, null ids likewise (their paragraphs count together; rows equal in
id and text count once); extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import json
import math
import random
import re
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_PROBABILITY = 0.6
MIN_OVERLAP = 0.6

# Notices by licence family, as the licences recommend or contain them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "This project is licensed under the terms of the MIT license.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
        "SPDX-License-Identifier: MIT",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.", "Dedicated to the public domain under CC0 1.0 Universal."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense."],
}

# Paragraphs that have words of licences but are none.
OTHERS = [
    "You need a driving licence to hire a car here.", "Copyright 2020 the author. All rights reserved.", "The shop holds a licence to sell alcohol.", "With kind permission of the museum.", "The warranty covers repairs for two years.",
    "She studied physics at MIT and taught at Boston.", "The Apache people live in Arizona.", "Apache web server logs are rotated daily.", "The house of commons debated the bill for hours.", "A software license costs fifty euros a seat.",
    "Please send a cc to the whole team.", "BSD systems were first written at Berkeley.", "The license plate was stolen.", "No part of this book may be copied without the written permission of the publisher.", "Mozilla released a new browser version.",
    "Read the license agreement before you install the software.", "The general public is not admitted.", "This product is sold as is without warranty by the store.", "The work of the foundation is free for all visitors.", "Copyright law protects the form of a work.",
    "Your license has expired and must be renewed.", "The engine has 50 cc and four gears.", "Distribution of the software to other countries needs a permit.", "All software of the library is under review.", "The terms of use of the site are here.",
]
UNKNOWN = "unknown"

# The commonest words of English; n-grams of these alone weigh nothing.
COMMON = (
    "the of and to in a is that it for was on are as with his they at be this have from or one had by but not what all were we when your can said there use an each which she do how their if will up other about out many then them "
    "these so some her would make like him into time has look two more go see no way could people my than first been who its now find long down day did get come made may part over only little work know place years live me back give "
    "most very after thing our just name good sentence man think say great where help through much before line right too any same want also well such because here must even found should under above following required 0"
)

# Notices and other paragraphs for calibration, worded otherwise than what is trained on.
CALIBRATION = {
    "Apache-2.0": ["Distributed under the Apache License 2.0, see the NOTICE file.", "You may obtain a copy of the Apache License Version 2.0 at the address below."],
    "MIT": ["The code is MIT licensed.", "Available under the MIT license; see LICENSE for details.", "Permission is granted to any person obtaining a copy of this software, free of charge, to deal in it without restriction."],
    "BSD": ["This code is distributed under the BSD 3-Clause license.", "Redistribution and use in source and binary forms are permitted under these conditions."],
    "GPL": ["Distributed under the GNU General Public License version 3 or later.", "This is free software under the terms of the GNU GPL as published by the Free Software Foundation."],
    "LGPL": ["The library is distributed under the GNU Lesser General Public License.", "Licensed under LGPL-2.1 or later."],
    "AGPL": ["Licensed under the GNU Affero General Public License version 3.", "AGPL-3.0 applies to the server."],
    "MPL": ["This file is subject to the Mozilla Public License 2.0.", "Source code under MPL-2.0."],
    "ISC": ["ISC licensed.", "Permission to use, copy, modify, and distribute this software with or without fee is granted."],
    "CC-BY": ["Text available under the Creative Commons Attribution 4.0 license."],
    "CC-BY-SA": ["Content is available under CC BY-SA 4.0, Creative Commons Attribution-ShareAlike."],
    "CC-BY-NC": ["Creative Commons Attribution-NonCommercial 4.0, CC BY-NC."],
    "CC-BY-ND": ["Creative Commons Attribution-NoDerivatives 4.0, CC BY-ND."],
    "CC0": ["Released to the public domain with CC0 1.0 Universal."],
    "Unlicense": ["Free and unencumbered software, see the Unlicense."],
    UNKNOWN: [
        "He renewed his fishing licence last spring.", "The copyright holders of the film could not be found.", "Permission to enter the site must be asked for in writing.", "The software is provided to all schools of the district.", "A commercial kitchen needs a license.",
        "The library is open to the general public on weekdays.", "Source of the quotation: the author's notes, second version.", "The conditions are met when all files have been received.", "The foundation was published in the hope that it would be useful.", "Any person may use the code of the door.",
        "The project is free of charge for visitors.", "This program was broadcast in the house of commons.", "Modify the form and send copies to the office.", "The warranty of the merchant covers any purpose.", "Attribution of the painting to the master is in doubt.", "Apache helicopters were distributed to the bases.",
    ],
}

# Words that mark a comment line.
COMMENT_WORDS = ("dnl", "rem")


def _words(text: str) -> list[str]:
    return re.sub("[^a-z0]+", " ", re.sub("[0-9]+", "0", text.lower())).split()


#: Words between the first and the last line of a run: no template has more.
MAX_WORDS = max(len(_words(t)) for texts in TEMPLATES.values() for t in texts)


def grams(text: str) -> set[str]:
    w = _words(text)
    return {" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}


@cache
def model() -> dict:
    """families (the last is unknown), bias, weights {n-gram: [by family]}, temperature, templates [(family, n-grams)]."""
    rnd, families, common = random.Random(11), [*TEMPLATES, UNKNOWN], set(COMMON.split())
    texts: list[tuple[str, int]] = []
    for k, family in enumerate(families):
        for text in TEMPLATES.get(family, OTHERS):
            w = text.split()
            texts.append((text, k))
            for _ in range(12 if k < len(families) - 1 else 6):
                kept = [x for x in w if rnd.random() > 0.1] or w
                other = rnd.choice(OTHERS).split() if rnd.random() < 0.4 else []
                texts.append((" ".join([*other, *kept]), k))
    shared = {t for t in (" ".join(rnd.sample(rnd.choice(rnd.choice(list(TEMPLATES.values()))).split(), 2)) for _ in range(150))}
    texts += [(t, len(families) - 1) for t in sorted(shared) if not re.search("apache|mit|bsd|gnu|gpl|mozilla|mpl|isc|cc|commons|unlicense|affero|spdx", t.lower())]
    rnd.shuffle(texts)
    vocabulary = {g: i for i, g in enumerate(sorted({g for ts in TEMPLATES.values() for t in ts for g in grams(t)}))}

    def matrix(rows: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(rows), len(vocabulary)))
        for i, (t, _) in enumerate(rows):
            x[i, [vocabulary[g] for g in grams(t) if g in vocabulary and not common.issuperset(g.split())]] = 1
        return x, np.array([k for _, k in rows])

    def softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    x, y = matrix(texts)
    w, b, rate, l1, one = np.zeros((len(vocabulary), len(families))), np.zeros(len(families)), 0.5, 3e-4, np.eye(len(families))[y]
    for _ in range(800):
        e = (softmax(x @ w + b) - one) / len(x)
        w -= rate * (x.T @ e)
        b -= rate * e.sum(0)
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0)
    held, own = matrix([(t, k) for k, f in enumerate(families) for t in CALIBRATION[f]])
    z = held @ w + b
    temperature = min(np.geomspace(0.05, 4, 60), key=lambda t: -np.log(np.maximum(softmax(z / t)[np.arange(len(z)), own], 1e-12)).mean())
    names = list(vocabulary)
    templates = [(k, sorted(grams(t))) for k, f in enumerate(families[:-1]) for t in TEMPLATES[f]]
    return {
        "families": families, "bias": [round(float(v), 4) for v in b], "temperature": round(float(temperature), 4),
        "weights": {names[i]: [round(float(v), 4) for v in w[i]] for i in range(len(names))}, "templates": templates,
    }


@cache
def telling() -> tuple[list[str], list[str]]:
    """(words that carry weight, those of them that alone can lift a family to MIN_PROBABILITY).

    A family that reaches it is ahead of ``unknown`` by the log odds of
    MIN_PROBABILITY. A paragraph has this from the n-grams whose words, but for
    common ones, it holds; for one word alone these are known beforehand.
    """
    m, common = model(), set(COMMON.split())
    unknown, need = len(m["families"]) - 1, math.log(MIN_PROBABILITY / (1 - MIN_PROBABILITY)) * m["temperature"]
    words = sorted({x for g, w in m["weights"].items() if any(w) for x in g.split()} - common)

    def ahead(x: str | None) -> float:
        of = [w for g, w in m["weights"].items() if set(g.split()) - common == {x}]
        return max(m["bias"][k] - m["bias"][unknown] + sum(max(0.0, w[k] - w[unknown]) for w in of) for k in range(unknown))

    if ahead(None) >= need:
        raise ValueError("a paragraph without any word that carries weight could have a licence")
    return words, [x for x in words if ahead(x) >= need]


def _weights(df: DataFrame) -> DataFrame:
    """g, w array<double>, ts array<int> (templates that hold the n-gram): a few thousand rows from a literal."""
    m = model()
    within: dict[str, list[int]] = {}
    for t, (_, gs) in enumerate(m["templates"]):
        for g in gs:
            within.setdefault(g, []).append(t)
    rows = [{"g": g, "w": w, "ts": within.get(g, [])} for g, w in m["weights"].items()]
    return df.sparkSession.range(1, numPartitions=1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), "array<struct<g string, w array<double>, ts array<int>>>")).alias("r")).select("r.*")


def _split_words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), "[0-9]+", "0"), "[^a-z0]+"), lambda x: x != "")


def _line_words(line: Column) -> Column:
    return F.filter(_split_words(line), lambda x, i: ~((i == 0) & x.isin(*COMMENT_WORDS)))


def _words_of(names: list[str]) -> Column:
    return F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")


def _may_have(words: Column) -> Column:
    """Whether text with these words can have a licence: two words that carry weight, or one that alone suffices."""
    many, alone = map(_words_of, telling())
    own = F.array_intersect(words, many)
    return (F.size(own) > 1) | (F.size(F.array_intersect(own, alone)) > 0)


def _grams(w: Column) -> Column:
    def of(n: int) -> Column:
        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(w, of(2), of(3)))


def _between(sizes: Column, s: Column, e: Column) -> Column:
    """Words of the lines after s and before e."""
    return F.when(e - s > 1, F.aggregate(F.slice(sizes, s + 2, e - s - 1), F.lit(0), lambda a, x: a + x)).otherwise(0)


def _runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row (of its text), s and e (first and last line), gs: each run that may have a licence once, from its first line with a word that carries weight."""
    reach = MAX_WORDS + 1  # lines of a run have a word at least
    texts = docs.filter(_may_have(_split_words(F.col(text_col)))).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row"), F.split(text_col, "\n").alias("ls")).dropDuplicates(["doc_id", "row"])
    words = F.transform("ls", _line_words)
    lines = texts.select("doc_id", "row", F.transform(words, lambda w: F.struct(w.alias("ws"), F.array_intersect(w, _words_of(telling()[0])).alias("own"))).alias("ls"))
    own = lambda c, start, n: F.flatten(F.transform(F.slice(c, start, n), lambda x: x["own"]))
    marked = F.filter(F.sequence(F.lit(0), F.size("ls") - 1), lambda i: (F.size(F.get("ls", i)["own"]) > 0) & _may_have(own(F.col("ls"), i + 1, F.lit(reach + 1))))
    near = F.transform(marked, lambda i: F.struct(i.alias("line"), F.slice("ls", F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("near")))
    lines = lines.select("doc_id", "row", F.explode(near).alias("x")).select("doc_id", "row", "x.line", "x.near", F.least("x.line", F.lit(reach)).alias("p"))
    lines = lines.withColumn("sizes", F.transform("near", lambda x: F.size(x["ws"]))).withColumn("on", F.transform("near", lambda x: F.size(x["own"]) > 0))
    p, sizes, last = F.col("p"), F.col("sizes"), F.size("sizes") - 1

    def unbroken(s: Column, e: Column) -> Column:
        return ~F.exists(F.slice(sizes, s + 1, e - s + 1), lambda n: n == 0) & (_between(sizes, s, e) < MAX_WORDS)

    starts = F.filter(F.sequence(F.lit(0), p), lambda s: (s == p) | ~F.exists(F.slice("on", s + 1, p - s), lambda x: x) & unbroken(s, p))
    ends = F.filter(F.sequence(p, last), lambda e: ((e == p) | unbroken(p, e)) & _may_have(own(F.col("near"), p + 1, e - p + 1)))
    lines = lines.withColumn("starts", starts).withColumn("ends", ends)
    pairs = F.flatten(F.transform("starts", lambda s: F.transform(F.filter("ends", lambda e: _between(sizes, s, e) < MAX_WORDS), lambda e: F.struct(s.alias("s"), e.alias("e")))))
    runs = lines.select("doc_id", "row", "line", "p", "near", F.explode(pairs).alias("x"))
    w = F.flatten(F.transform(F.slice("near", F.col("x.s") + 1, F.col("x.e") - F.col("x.s") + 1), lambda x: x["ws"]))
    runs = runs.select("doc_id", "row", (F.col("line") - F.col("p") + F.col("x.s")).alias("s"), (F.col("line") - F.col("p") + F.col("x.e")).alias("e"), w.alias("w"))
    return runs.select("doc_id", "row", "s", "e", _grams(F.col("w")).alias("gs"))


def _clash(a: Column, b: Column) -> Column:
    """One family and a common line, or one within the other."""
    return (a["family"] == b["family"]) & (a["s"] <= b["e"]) & (b["s"] <= a["e"]) | (a["s"] <= b["s"]) & (b["e"] <= a["e"]) | (b["s"] <= a["s"]) & (a["e"] <= b["e"])


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The scored paragraphs: doc_id, line and last (its place), family, probability, confirmed, overlap."""
    m = model()
    key = ["doc_id", "row", "s", "e"]
    hits = _runs(docs, id_col, text_col).select(*key, F.explode("gs").alias("g")).join(F.broadcast(_weights(docs)), "g")
    k = len(m["families"])
    sums = hits.groupBy(*key).agg(*(F.sum(F.col("w")[i]).alias(f"z{i}") for i in range(k)), F.flatten(F.collect_list("ts")).alias("ts"))
    logits = F.array(*((F.col(f"z{i}") + F.lit(m["bias"][i])) / F.lit(m["temperature"]) for i in range(k)))
    scored = sums.select(*key, "ts", logits.alias("z")).withColumn("top", F.array_max("z"))
    scored = scored.select(*key, "ts", (F.array_position(F.col("z"), F.col("top")) - 1).cast("int").alias("k"), (1 / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))).alias("probability"))
    sizes = F.from_json(F.lit(json.dumps([{"t": t, "k": f, "n": len(gs)} for t, (f, gs) in enumerate(m["templates"])])), "array<struct<t int, k int, n int>>")
    overlap = F.coalesce(F.array_max(F.transform(F.filter(sizes, lambda s: s["k"] == F.col("k")), lambda s: F.size(F.filter("ts", lambda t: t == s["t"])) / s["n"])), F.lit(0.0))
    sure = (F.col("k") < k - 1) & (F.col("probability") >= MIN_PROBABILITY)
    family = F.when(sure, F.element_at(F.array(*map(F.lit, m["families"])), F.col("k") + 1)).otherwise(UNKNOWN)
    scored = scored.withColumn("overlap", overlap).select(*key, family.alias("family"), "probability", (sure & (F.col("overlap") >= MIN_OVERLAP)).alias("confirmed"), "overlap").filter("s = e OR confirmed")
    one = F.struct((-F.col("overlap")).alias("order"), (F.col("e") - F.col("s")).alias("more"), "s", "e", "family", "probability", "confirmed", "overlap")
    by_text = scored.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(one)).alias("all"))
    sure_ones = F.filter("all", lambda x: x["confirmed"])
    kept = F.aggregate(sure_ones, F.filter("all", lambda x: F.lit(False)), lambda got, x: F.when(F.exists(got, lambda y: _clash(x, y)), got).otherwise(F.concat(got, F.array(x))))
    by_text = by_text.withColumn("kept", kept)
    rest = F.filter("all", lambda x: ~x["confirmed"] & ~F.exists("kept", lambda y: (y["s"] <= x["s"]) & (x["e"] <= y["e"])))
    found = by_text.select("doc_id", F.explode(F.concat("kept", rest)).alias("x")).select("doc_id", "x.*")
    return found.select("doc_id", F.col("s").alias("line"), F.col("e").alias("last"), "family", "probability", "confirmed", "overlap")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_paragraphs (lines that are not empty), n_scored (the same, but a licence of several lines is one), n_licensed (confirmed), n_unconfirmed, families (sorted, comma-joined), probability (the largest of a confirmed paragraph, 6 digits, else 0)."""
    count = F.size(F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: F.trim(x) != ""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row"), count.cast("long").alias("n")).groupBy("doc_id", "row").agg(F.first("n").alias("n"))
    base = texts.groupBy("doc_id").agg(F.sum("n").alias("n_paragraphs"))
    known = F.col("family") != UNKNOWN
    found = paragraphs(docs, id_col, text_col).groupBy("doc_id").agg(
        F.count_if("confirmed").alias("n_licensed"),
        F.sum(F.when(F.col("confirmed"), F.col("last") - F.col("line")).otherwise(0)).alias("more_lines"),
        F.count_if(known & ~F.col("confirmed")).alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"),
        F.round(F.max(F.when(F.col("confirmed"), F.col("probability"))), 6).alias("probability"),
    )
    both = base.join(found.withColumnRenamed("doc_id", "k"), F.col("doc_id").eqNullSafe(F.col("k")), "left")
    n = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("more_lines", "n_licensed", "n_unconfirmed")}
    return both.select("doc_id", "n_paragraphs", (F.col("n_paragraphs") - n["more_lines"]).alias("n_scored"), *(n[c].alias(c) for c in ("n_licensed", "n_unconfirmed")), F.coalesce("families", F.lit("")).alias("families"), F.coalesce("probability", F.lit(0.0)).alias("probability"))
