import zlib

import numpy as np

from telar.llm import toxicity


def test_fit_learns_pairs():
    """A pair that is toxic only together: insult with group mention."""
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(600):
        a, b = rng.random(2) < 0.5
        noise = rng.integers(100, 140, 5)
        rows.append((np.unique(np.array([1] * int(a) + [2] * int(b) + noise.tolist(), np.int64)), int(a and b)))
    m = toxicity.fit(rows, steps=400)
    assert m.score({1, 2}) > 0.7
    assert max(m.score({1}), m.score({2}), m.score(set())) < 0.5


def test_pairs_tell_more_than_additive_weights(docs):
    """Insults and group mentions put into texts of documents; both together are toxic, several of one kind are not."""
    rng = np.random.default_rng(3)
    insults, groups = ([toxicity.terms(w.encode()) for w in ws] for ws in (("fools", "vermin", "dirt", "dregs"), ("bakers", "tailors", "miners", "sailors")))
    texts = [toxicity.terms((r.text or "").encode()) for r in docs.collect()]
    rows = []
    for i in range(2400):
        a, b = rng.choice([0, 0, 1, 2, 3], 2)
        words = set(texts[i % len(texts)])
        for of, n in ((insults, a), (groups, b)):
            words = words.union(*(of[j] for j in rng.choice(4, n, replace=False)))
        rows.append((np.array(sorted(words), np.int64), int(a > 0 and b > 0)))
    held = rows[1600:]

    def right(m):
        return sum((m.score(set(x.tolist())) >= 0.5) == bool(y) for x, y in held) / len(held)

    additive, machine = right(toxicity.fit(rows[:1600], factors=0)), right(toxicity.fit(rows[:1600]))
    assert machine > 0.97
    assert additive < 0.9


def test_terms_that_tell_in_pairs_alone():
    """Terms that say nothing alone (as often toxic as not) become features by their pair."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(2000):
        a, b = rng.random(2) < 0.5
        rows.append((np.unique(np.array([1] * int(a) + [2] * int(b) + (100 + rng.integers(0, 400, 8)).tolist(), np.int64)), int(a == b)))
    m = toxicity.fit(rows, features=64)
    assert {1, 2} <= set(m.buckets.tolist())
    assert min(m.score({1, 2}), m.score(set())) > 0.7
    assert max(m.score({1}), m.score({2})) < 0.3


def test_one_text_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "b"), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    assert len(toxicity.sample(docs, labels)) <= 3


def test_score_is_the_formula():
    rng = np.random.default_rng(2)
    m = toxicity.Machine(-0.3, np.array([3, 5, 9]), rng.normal(size=3), rng.normal(size=(3, 4)))
    z = -0.3 + m.w.sum() + sum(m.v[i] @ m.v[j] for i in range(3) for j in range(i))
    assert np.isclose(m.score({3, 5, 9, 77}), 1 / (1 + np.exp(-z)))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.report(docs, labels).join(labels.filter("toxic IS NOT NULL").dropDuplicates(["doc_id"]), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    toxic = [r for r in held if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)  # about a tenth of these labels name texts without any telling word
    assert sum(r.predicted for r in held if not r.toxic) <= 0.01 * len(held)
    assert all(r.predicted == (r.score >= 0.7) for r in got)


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (2, None), (None, 1), (5, 7), (7, 0)], "doc_id long, toxic int")
    got = toxicity.report(odd, labels).collect()
    assert len(got) == odd.count()
    assert all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert toxicity.report(none, labels).count() == 0
    bare = toxicity.report(odd, labels.limit(0)).collect()
    assert {r.predicted for r in bare} == {0}
    kept = toxicity.scored(odd, toxicity.train(odd, labels), score_col="score")
    assert kept.columns == odd.columns
