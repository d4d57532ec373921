import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telar.llm import variants as V
from telar.llm.queries import letter_lost, op13_spelling_variants


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_grouped(n, ratio=5):
    """All words that share a word with one code point left out, compared."""
    by = defaultdict(set)
    for w in n:
        by[w].add(w)
        for i in range(len(w)):
            by[w[:i] + w[i + 1 :]].add(w)
            by[w[:i], w[i + 1 :]].add(w)
    partners = defaultdict(set)
    for ws in by.values():
        for a in ws:
            partners[a] |= {b for b in ws if near(a, b)}
    form = {}
    for w in n:
        best = min(partners[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n[w], form[w], root, len(partners[w]), n[form[w]] if form[w] is not None else None))
    return out


def brute_counts(rows, least=6, often=5):
    n = Counter()
    for doc_id, text in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            r = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{doc_id}:{r}".encode())
            if doc_id is not None and h % 199 == 0:
                r = r[: h % len(r)] + r[h % len(r) + 1 :]
            n[r] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= often}


def rows_of(words):
    return sorted(words.items())


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=7), max_size=60))
def test_tries_property(words):
    """Tries of every word and length, without Spark."""
    rows = []
    for w in words:
        for m in {len(w) - 1, len(w)} - {0}:
            t = m // 2
            rows += [(m, t, 0, 1 << 30, w[:t], w, 1), (m, 0, t, t, w[len(w) - t :], w, 1)]
    got = [tuple(sorted((a, b))) for a, _, b, _ in V._pairs(sorted(rows))] if rows else []
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if a < b and near(a, b)}


@pytest.mark.parametrize("split_over", [V.SPLIT_OVER, 30, 3])
def test_dealt_again(spark, split_over):
    """One stem holds most words; tries are dealt out until they are short, and no pair is lost or found twice."""
    words = {f"contra{a}{b}ción{c}": 1 + 37 * i % 1000 for i, (a, b, c) in enumerate((a, b, c) for a in ("", "b", "bb", "c", "ß") for b in "xyzñ" for c in ("", "é", "e", "es", "ee"))} | {f"{a}ontrario": 9 for a in "abcdeç"}
    df = spark.createDataFrame(rows_of(words), "word string, n long")
    pairs = V.near_pairs(df, split_over=split_over).collect()
    got = [tuple(sorted((r.a, r.b))) for r in pairs]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if a < b and near(a, b)}
    assert all((words[r.a], words[r.b]) == (r.na, r.nb) for r in pairs)
    assert {tuple(r) for r in V.grouped(df, split_over=split_over).collect()} == brute_grouped(words)


def test_chains_and_ties(spark):
    words = {"palabra": 5, "palabras": 25, "palabrasa": 125, "palabrase": 125, "palabrasaa": 625, "palabrasaab": 3125, "solita": 3, "solite": 15, "solito": 15}
    got = {r.word: r for r in V.grouped(spark.createDataFrame(rows_of(words), "word string, n long")).collect()}
    assert {tuple(r) for r in got.values()} == brute_grouped(words)
    assert got["palabra"].root == "palabrasaab"
    assert got["solita"].form == "solite"


def test_query_same_as_brute_force(spark, sf, docs):
    n = brute_counts([(r.doc_id, r.text) for r in docs.collect()])
    got = [tuple(r) for r in op13_spelling_variants(spark, sf).collect()]
    assert len(got) == len(set(got)) == len(n)
    assert set(got) == brute_grouped(n)
    assert sum(r[2] is not None for r in got) > 5


def test_odd_rows(spark, odd, none):
    n = brute_counts([(r.doc_id, r.text) for r in odd.collect()])
    assert n
    got = V.grouped(V.counted(odd, change=letter_lost))
    assert got.columns == ["word", "n", "form", "root", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == brute_grouped(n)
    assert V.grouped(V.counted(none)).count() == 0
    twice = spark.createDataFrame([("abcdef", 1), ("abcdef", 2), (None, 3), ("abcdeg", 15), ("x" * 3000, 1), ("x" * 3001, 9)], "word string, n long")
    assert {(r.word[:6], r.n, (r.form or "")[:6]) for r in V.grouped(twice).collect()} == {("abcdef", 3, "abcdeg"), ("abcdeg", 15, ""), ("xxxxxx", 1, "xxxxxx"), ("xxxxxx", 9, "")}
