import math
import re

import pytest

from telar.llm import licenses as L


def brute_force(text):
    """The report of one document in plain Python: every run of lines is scored, with no words looked for beforehand."""
    m = L.model()
    lines = (text or "").split("\n")
    words = [re.sub("[^a-z0]+", " ", re.sub("[0-9]+", "0", x.lower())).split() for x in lines]
    words = [w[1:] if w and w[0] in ("dnl", "rem") else w for w in words]
    sure, loose = [], []  # (-overlap, lines more, first, last, family, probability); (line, family known)
    for s in range(len(lines)):
        for e in range(s, len(lines)):
            if e > s and (not words[s] or not words[e] or sum(map(len, words[s + 1 : e])) >= L.MAX_WORDS):
                break
            w = [x for ws in words[s : e + 1] for x in ws]
            gs = {" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)} & m["weights"].keys()
            z = [(sum(m["weights"][g][i] for g in gs) + b) / m["temperature"] for i, b in enumerate(m["bias"])]
            top = max(z)
            k, p = z.index(top), 1 / sum(math.exp(v - top) for v in z)
            known = k < len(z) - 1 and p >= 0.6
            overlap = max((len(gs & set(t)) / len(t) for f, t in m["templates"] if f == k), default=0)
            if known and overlap >= 0.6:
                sure.append((-overlap, e - s, s, e, k, p))
            elif s == e:
                loose.append((s, known))
    kept = []
    for x in sorted(sure):
        s, e = x[2:4]
        if not any(x[4] == y[4] and s <= y[3] and y[2] <= e or s <= y[2] and y[3] <= e or y[2] <= s and e <= y[3] for y in kept):
            kept.append(x)
    loose = [known for i, known in loose if not any(y[2] <= i <= y[3] for y in kept)]
    families = ",".join(sorted({m["families"][y[4]] for y in kept}))
    n = sum(bool(x.strip(" ")) for x in lines)
    return n, n - sum(y[1] for y in kept), len(kept), sum(loose), families, round(max((y[5] for y in kept), default=0.0), 6)


@pytest.mark.parametrize(
    ("text", "families"),
    [
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("Released under the MIT License.", "MIT"),
        ("x\nThis work is licensed under the GNU General Public License, version 2.\ny", "GPL"),
        ("Licensed under CC BY-NC 3.0.\nLicensed under CC BY 4.0.", "CC-BY,CC-BY-NC"),
        ("SPDX-License-Identifier: MPL-2.0", "MPL"),
        ("Your fishing license expired.", ""),
        ("Copyright 2020 Foo. All rights reserved.", ""),
        ("The Apache people and a BSD system", ""),
    ],
)
def test_families(text, families):
    assert brute_force(text)[4] == families


def test_every_template_is_its_family():
    for family, texts in L.TEMPLATES.items():
        for t in texts:
            assert brute_force(t)[4] == family, t
    for t in L.OTHERS:
        assert brute_force(t)[2] == 0, t


def test_same_as_brute_force(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = L.report(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:] == brute_force(texts[r.doc_id])


def wrapped(text, width, prefix=""):
    import textwrap

    return "\n".join(prefix + x for x in textwrap.wrap(text, width))


@pytest.mark.parametrize(("width", "prefix"), [(30, ""), (50, "# "), (60, " * "), (70, ""), (72, "// "), (76, "dnl ")])
def test_wrapped_notices(width, prefix):
    """A template is found however it is wrapped, with text and other notices around it."""
    for family, texts in L.TEMPLATES.items():
        for t in texts:
            got = brute_force(wrapped(t, width, prefix))
            assert got[2:5] == (1, 0, family), t
            assert family in brute_force(f"A first line of prose\n{wrapped(t, width, prefix)}\nand a last one.")[4].split(","), t
    both = f"{wrapped(L.TEMPLATES['MIT'][1], width, prefix)}\n{prefix}\n{wrapped(L.TEMPLATES['BSD'][0], width, prefix)}\n\nReleased under the ISC License."
    assert brute_force(both)[2:5] == (3, 0, "BSD,ISC,MIT")


def test_wrapped_same_as_brute_force(spark):
    texts = [wrapped(t, width, prefix) for width, prefix in ((30, ""), (70, "# ")) for ts in L.TEMPLATES.values() for t in ts]
    texts += ["\n".join(texts[i : i + 3]) for i in range(0, 40, 3)] + ["word\n" * 60 + texts[5] + "\nword" * 60, "Permission is hereby granted\n\nfree of charge, to any person", *L.OTHERS]
    df = spark.createDataFrame([*enumerate(texts), (0, texts[0])], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in L.report(df.filter("doc_id > 0")).collect()}
    assert got == {i: brute_force(t) for i, t in enumerate(texts) if i}
    assert next(iter(L.report(df.filter("doc_id = 0")).collect())).n_licensed == 1


def test_odd_rows(spark, odd, none):
    more = odd.select("doc_id", "text", "kind").unionByName(spark.createDataFrame([(8, "émit\nReleased under the MIT License.\n\n", "k"), (None, "Released under the MIT License.", "k"), (8, "émit\nReleased under the MIT License.\n\n", "k")], "doc_id long, text string, kind string"))
    got = {r.doc_id: r for r in L.report(more).collect()}
    assert len(got) == 9
    assert (got[8].n_licensed, got[8].families) == (1, "MIT")
    assert got[None].families == "MIT"
    assert (got[3].n_paragraphs, got[3].n_scored) == (0, 0)
    assert L.report(none).count() == 0


def test_no_python_in_the_plan(spark, docs):
    plan = L.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_no_paragraph_is_left_out_unscored(spark):
    """Notices in other words, and the disclaimers, are classified; words that decide come from the weights, not from a list."""
    disclaimer = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
    rows = ["Released under MIT", wrapped(disclaimer, 60), "no licence at all", "the of and to in", "\n".join(["a line of prose", *L.COMMON.split()])]
    got = {r.doc_id: tuple(r)[1:] for r in L.report(spark.createDataFrame([*enumerate(rows)], "doc_id long, text string")).collect()}
    assert got == {i: brute_force(t) for i, t in enumerate(rows)}
    assert got[0][1] == 1
    assert got[1][2:5] == (1, 0, "MIT")
    assert not set(L.telling()[0]) & set(L.COMMON.split())


def test_calibration_is_independent():
    trained = {t for ts in L.TEMPLATES.values() for t in ts} | set(L.OTHERS)
    held = [(f, t) for f, ts in L.CALIBRATION.items() for t in ts]
    assert not trained & {t for _, t in held}
    m = L.model()
    right = 0
    for family, t in held:
        gs = L.grams(t) & m["weights"].keys()
        z = [sum(m["weights"][g][i] for g in gs) + b for i, b in enumerate(m["bias"])]
        right += m["families"][z.index(max(z))] == family
    assert right >= 0.8 * len(held)


def test_repeated_rows_count_once(spark):
    df = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (1, "c"), (None, "d"), (None, "d")], "doc_id long, text string")
    assert {tuple(r)[:3] for r in L.report(df).collect()} == {(1, 3, 3), (None, 1, 1)}
