"""The pipeline against its stages done in plain Python."""

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline as P
from telar.llm import toxicity
from telar.llm.queries import QUERIES, SQL, vocabulary

from .test_simhash import groups, plain
from .test_wumanber import brute


def test_stages():
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "sentencepiece"]
    assert {int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 14))
    assert set(SQL) <= set(QUERIES)


def test_run(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    machine = toxicity.train(docs, labels)
    kept = {r.doc_id: r.text for r in docs.collect() if machine.score(toxicity.terms((r.text or "").encode())) < 0.7}
    label = groups({i: plain(t) for i, t in kept.items()})
    kept = {i: t for i, t in kept.items() if label[i] == i}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {i: t for i, t in kept.items() if not brute(t, items)[-1]}
    got = {r.doc_id: r for r in P.run(spark, sf).collect()}
    assert got.keys() == kept.keys()
    assert len(kept) < docs.count()
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    for i, r in got.items():
        assert (r.text, r.round_trip, r.n_tokens) == (kept[i], True, len(r.input_ids))
        assert r.input_ids == sp.encode(kept[i])


def test_odd_rows(spark, odd, none, sf):
    for df, name in ((odd, "odd"), (none, "none")):
        d = df
        for _, stage in P.STAGES[:-1]:
            d = stage(spark, d, sf)
            assert d.columns == df.columns, name
        out = P.STAGES[-1][1](spark, d, sf).collect()
        assert len({r.doc_id for r in out if r.doc_id}) == len([r for r in out if r.doc_id])
        if name == "odd":
            assert {r.doc_id for r in out} == {1, 2, 4, 5, 7, None}
            assert sum(r.doc_id is None for r in out) == 2


def test_shared_and_missing_ids(spark, sf):
    """Rows are chosen by their text: an id shared by unrelated texts loses none of them, copies without an id leave one."""
    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(1, one), (1, two), (1, one), (2, two), (3, three), (2, three), (None, one), (None, one), (None, "no other"), (None, None), (None, None), (5, "ends here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in P.one_of_each(spark, df, sf).collect()]
    assert sorted(got, key=repr) == sorted([(1, one), (1, two), (2, three), (5, "ends here"), (None, one), (None, "no other"), (None, None)], key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, sf, name):
    df = QUERIES[name](spark, sf)
    source = "pages" if name.startswith(("op3_", "op5_")) else "documents"
    if name.startswith("op13_"):  # a row a word
        assert df.count() == df.select("word").distinct().count() > 0
    else:
        assert df.count() == spark.read.parquet(f"{sf}/{source}.parquet").count()
    assert np.all([c == c.lower() for c in df.columns])
