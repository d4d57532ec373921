import collections
import math
import zlib

import numpy as np
import pytest

from telar.llm import interpolation as I


def brute(docs, folds=10):
    """(doc_id, held_out, n, known, N, base, score) of each row, by plain counting."""
    tok = [(d, [*(t or "").encode().translate(I._LOWER).split(), b""]) for d, t in docs]
    fold = lambda d: None if d is None else zlib.crc32(str(d).encode()) % folds

    def counts(own):
        u, b = collections.Counter(), collections.Counter()
        for d, ws in tok:
            if own(fold(d)):
                p = b""
                for w in ws:
                    u[w] += 1
                    b[p, w] += 1
                    p = w
        return u, b

    um, bm = counts(lambda f: f not in (0, 1))
    nm, cell = sum(um.values()), lambda p: int(round(8 * math.log2(p))) if p > 0 else I.NONE
    hist = collections.Counter()
    bucket = lambda c: int(I.bucket(np.array([c]))[0])
    for d, ws in tok:
        if fold(d) == 1:
            p = b""
            for w in ws:
                hist[bucket(um[p]), cell(bm[p, w] / max(um[p], 1)), cell(um[w] / max(nm, 1))] += 1
                p = w
    weights = I.learn(np.array(sorted((*k, n) for k, n in hist.items()), np.int64).reshape(-1, 4), len(um))
    u, b = counts(lambda f: f != 0)
    n, v = sum(u.values()), len(u)
    out = []
    for d, ws in tok:
        base = sum(math.log10((u[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        p, s = b"", 0.0
        for w in ws:
            l0, l1, l2 = weights[bucket(u[p])] if n else (1, 0, 0)
            s += math.log10(l0 / (v + 1) + l1 * u[w] / max(n, 1) + l2 * b[p, w] / max(u[p], 1))
            p = w
        out.append((d, fold(d) == 0, len(ws), sum(u[w] > 0 for w in ws), n, base, s))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[6], 5))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("how", [{}, {"block_bytes": 20_000, "range_tokens": 3_000}])
def test_same_as_brute_force(docs, how):
    same(I.scores(docs, **how).collect(), brute([(r.doc_id, r.text) for r in docs.collect()]))


def test_better_than_base_on_held_out(docs):
    held = [r for r in I.scores(docs).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(odd, none, spark):
    same(I.scores(odd).collect(), brute([(r.doc_id, r.text) for r in odd.collect()]))
    assert I.scores(none).count() == 0
    only = spark.createDataFrame([(d, "a b") for d in range(300) if zlib.crc32(str(d).encode()) % 10 == 0], "doc_id long, text string")
    assert {(r.n_known, r.train_tokens, r.score) for r in I.scores(only).collect()} == {(0, 0, 0.0)}


def test_probabilities_sum_to_one():
    """Over the known words and the unknown one, in any context."""
    w = I.learn(np.array([[3, -8, -40, 900], [3, I.NONE, -40, 100], [0, I.NONE, -16, 60]], np.int64), 9)
    assert np.allclose(w.sum(1), 1)
    assert (w[:, 0] > 0).all()
    assert w[0, 2] == 0


def test_em_recovers_weights():
    """Held-out counts in proportion to a known mixture: EM returns it."""
    true, rows = np.array([0.1, 0.3, 0.6]), []
    for q2, q1, p2, p1 in ((-8, -24, 0.5, 0.125), (I.NONE, -8, 0, 0.5), (-16, -32, 0.25, 0.0625), (-16, I.NONE, 0.25, 0), (I.NONE, -16, 0, 0.25), (I.NONE, -32, 0, 0.0625)):
        rows.append((5, q2, q1, true @ [1 / 16, p1, p2]))
    rows = np.array(rows)
    rows[:, 3] = np.round(rows[:, 3] * 1e6)
    assert I.learn(rows.astype(np.int64), 15)[5] == pytest.approx(true, abs=0.15)
