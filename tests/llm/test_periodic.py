import hashlib
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telar.llm import periodic as P
from telar.llm.queries import op12_periodic_runs, tail_repeated


def brute(ws, least=6, exponent=4):
    """Every period at every place, by the definition."""
    n, out = len(ws), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            stretch = ws[i : j + q]
            smallest = next(p for p in range(1, q + 1) if all(stretch[k] == stretch[k + p] for k in range(len(stretch) - p)))
            if len(stretch) >= max(least, exponent * q) and smallest == q:
                out.add((i, len(stretch), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    ws = [w for w in re.split("[ \t-\r]+", text or "") if w]
    n = len(ws)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    got = brute(ws)
    best = min(got, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    drop = {i for s, m, q in got for i in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(got), *best, 1000 * best[1] // best[2] if got else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in got)), sha(" ".join(w for i, w in enumerate(ws) if i not in drop)))


@settings(max_examples=600, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_any_sequence(ids):
    assert P.runs(np.array(ids, np.int64)) == brute(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 4), min_size=1, max_size=11), st.integers(1, 70)), max_size=5), st.integers(3, 6))
def test_repeated_pieces(pieces, exponent):
    """Runs within runs, side by side and overlapping."""
    ids = [x for piece, n in pieces for x in (piece * n)[:n]]
    assert P.runs(np.array(ids, np.int64), exponent=exponent) == brute(ids, exponent=exponent)


def test_fibonacci_words():
    """The words with most runs."""
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert P.runs(np.array(b), exponent=3) == brute(b, exponent=3)
    assert len(P.runs(np.array(b), exponent=3)) > 20


@pytest.mark.parametrize("make", [lambda n: [0] * n + [1], lambda n: [0, 1] * (n // 2) + [2], lambda n: ([0] * 99 + [1]) * (n // 100), lambda n: list(range(n // 5)) * 5, lambda n: [0] * (n // 2) + [1] + [0] * (n // 2)])
def test_long_repetitions(make):
    """A million words take seconds."""
    ids = np.array(make(1_000_000), np.int64)
    began = time.perf_counter()
    got = P.runs(ids)
    assert time.perf_counter() - began < 60
    assert got[0][0] == 0
    assert max(r[1] for r in got) >= len(ids) // 2


def test_fewer_than_three_periods():
    with pytest.raises(ValueError):
        P.runs(np.zeros(9, np.int64), exponent=2)


def test_query_same_as_brute_force(spark, sf, docs):
    got = {tuple(r) for r in op12_periodic_runs(spark, sf).collect()}
    assert got == {brute_row(r.doc_id, r.text) for r in docs.collect()}
    assert sum(r[1] > 0 for r in got) > 10


def test_odd_rows(spark, odd, none):
    got = sorted(map(str, P.report(odd, before=tail_repeated).collect()))
    assert len(got) == odd.count()
    want = sorted(str(tuple(brute_row(r.doc_id, r.text))) for r in odd.collect() if r.doc_id != 5)
    assert sorted(str(tuple(r)) for r in P.report(odd.filter("doc_id IS NULL OR doc_id <> 5"), before=tail_repeated).collect()) == want
    long = P.report(odd.filter("doc_id = 5")).first()
    assert (long.start, long.length, long.period, long.exponent_milli) == (0, 80_000, 2, 40_000_000)
    assert long.collapsed_sha256 == hashlib.sha256(b"palabra larga.").hexdigest()
    assert P.report(none).count() == 0
    kept = P.with_runs(odd.withColumn("runs", odd["lang"]))
    assert set(kept.columns) == {*odd.columns, "runs", "collapsed"}
    assert {r.collapsed for r in kept.filter("text IS NULL").collect()} == {""}
