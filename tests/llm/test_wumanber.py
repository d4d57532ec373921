import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telar.llm import wumanber as W


def brute(text, items, window=10):
    ws = W.words((text or "").encode())
    hit, found = set(), set()
    for i, t in items:
        own = W.words((t or "").encode())
        for a in range(max(1, len(own) - window + 1) if own else 0):
            w = own[a : a + window]
            for at in range(len(ws) - len(w) + 1):
                if ws[at : at + len(w)] == w:
                    hit.update(range(at, at + len(w)))
                    if i is not None:
                        found.add(i)
    names = sorted(map(str, found))
    return len(ws), len(hit), len(found), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("a b c".split()), max_size=40), st.lists(st.lists(st.sampled_from("a b c".split()), max_size=8), max_size=5), st.integers(1, 4))
def test_search_property(text, items, window):
    windows = {}
    for i, it in enumerate(items):
        for a in range(max(1, len(it) - window + 1) if it else 0):
            windows.setdefault(tuple(x.encode() for x in it[a : a + window]), []).append(i)
    spans, found = W.Matcher(list(windows.items()))([x.encode() for x in text])
    n, hit, items_found, *_ = brute(" ".join(text), [(i, " ".join(it)) for i, it in enumerate(items)], window)
    assert (sum(b - a for a, b in spans), len(found)) == (hit, items_found)


def test_words():
    assert W.words("Don't STOP_now é-1 ×2".encode()) == ["don", "t", "stop", "now", "é", "1", "×2"] or W.words("Don't STOP_now é-1 ×2".encode()) == [x.encode() for x in ("don", "t", "stop", "now", "é", "1", "×2")]


@pytest.mark.parametrize("part", [W.PART_WORDS, 200])
def test_same_as_brute_force(spark, sf, docs, part):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = W.report(docs, bench, part_words=part).collect()
    assert sum(r.contaminated for r in rows) > 0
    for r in rows:
        assert tuple(r)[1:] == brute(texts[r.doc_id], items)


def test_odd_rows(spark, odd, none):
    rnd = random.Random(5)
    items = [(1, "quick brown fox"), (2, "Uno DOS tres"), (2, "uno dos tres"), (3, None), (4, ""), (None, "no id here"), (5, "palabra larga " * 6), (6, "quick brown fox")]
    rnd.shuffle(items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    small = odd.filter("doc_id IS NULL OR doc_id <> 5")
    got = sorted((tuple(r) for r in W.report(small, bench).collect()), key=repr)
    assert got == sorted(((r.doc_id, *brute(r.text, items)) for r in small.collect()), key=repr)
    long = W.report(odd.filter("doc_id = 5"), bench).first()
    assert (long.n_words, long.n_hit, long.n_items) == (80_000, 80_000, 1)
    assert W.report(none, bench).count() == 0
    assert not any(r.contaminated for r in W.report(odd, bench.limit(0)).collect())
    kept = W.clean(odd, bench)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id) == [2, 3, 6, 7]


def test_parts_are_bounded(spark):
    """A window of very many items and one very long item are cut into parts; the result is the same."""
    hot = " ".join(f"w{i}" for i in range(10))
    items = [(i, hot) for i in range(250)] + [(1000, " ".join(f"v{i}" for i in range(30)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    parts = list(W.window_parts(bench, part_words=100))
    assert len(parts) > 4
    assert max(sum(len(w) + len(i) for w, i in p) for p in parts) <= 120
    docs = spark.createDataFrame([(1, f"x {hot} y", 0), (1, f"x {hot} y", 0), (None, "v5 v6 v7 v8 v9 v10 v11 v12 v13 v14 v15", 0), (2, None, 0), (3, "clean Text, é9", 0)], "doc_id long, text string, __h int")
    want = sorted(((r.doc_id, *brute(r.text, items)) for r in docs.collect()), key=repr)
    for size in (100, W.PART_WORDS):
        assert sorted((tuple(r) for r in W.report(docs, bench, part_words=size).collect()), key=repr) == want
        assert W.clean(docs, bench, part_words=size).columns == docs.columns
