import random

import pytest
from pyspark.sql import functions as F

from telar.operators import search
from telar.operators.text_index import TextIndex, of_files

WORDS = "servicio servicios sistema sistemas web datos firma digital agua mesa red licencia mantenimiento de la compra".split()
QUERIES = [("a", "sistemas web"), ("b", "aguas"), ("c", "el servicio de mantenimiento"), ("d", "de la"), ("e", "firma digital de datos")]


def frame(spark, docs):
    return spark.createDataFrame(sorted(docs.items()), "id long, t string")


def rows(df):
    return {(r.term, r.id, round(r.rank, 6)) for r in df.collect()}


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(t,) for _, t in QUERIES], "term string")


@pytest.mark.parametrize("span", [4, 4096])
def test_upkeep_equals_a_rebuild(spark, queries, tmp_path, span):
    """Random new versions and deletions, with a compaction between them."""
    rng = random.Random(span)
    text = lambda: " ".join(rng.choices(WORDS, k=rng.randint(0, 12)))
    docs = {i: text() for i in range(-5, 25)}
    index = TextIndex(spark, f"file://{tmp_path}/i", ("t",), span=span, parts=4)
    assert not index.built()
    index.build(frame(spark, docs))
    for step in range(4):
        new = {rng.randrange(-5, 40): text() for _ in range(8)}
        gone = rng.sample(sorted(docs), 4)
        docs = {k: v for k, v in docs.items() if k not in gone} | new
        gen = index.apply(frame(spark, new), spark.createDataFrame([(k,) for k in gone], "id long"))
        if step == 0:  # a batch that is repeated writes the same
            assert index.apply(frame(spark, new), spark.createDataFrame([(k,) for k in gone], "id long"), gen=gen) == gen
        if step == 2:
            index.compact()
            index.vacuum()
    fresh = search.lexemes(frame(spark, docs), "id", ("t",))
    assert rows(index.hits(queries)) == rows(search.spanish_hits(fresh, queries))
    assert {tuple(map(str, r)) for r in index.lexemes().collect()} == {tuple(map(str, r)) for r in fresh.collect()}
    assert {r.stem for r in index.lexemes(["sistem", "agu"]).collect()} == {"sistem", "agu"}
    best = index.hits(queries, 2, [F.desc("t")], frame(spark, docs))
    assert max(r.n for r in best.groupBy("term").agg(F.count("*").alias("n")).collect()) <= 2


def test_a_failed_batch_is_not_read(spark, queries, tmp_path, monkeypatch):
    index = TextIndex(spark, f"file://{tmp_path}/i", ("t",)).build(frame(spark, {1: "agua"}))
    with monkeypatch.context() as m:
        m.setattr(TextIndex, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            index.apply(frame(spark, {2: "agua"}), frame(spark, {1: ""}))
    assert {r.id for r in index.hits(queries).collect()} == {1}
    index.apply(None, frame(spark, {7: ""}))  # takes the failed batch's number
    assert {r.id for r in index.hits(queries).collect()} == {1}


def test_reads_the_parts_of_its_stems(spark, tmp_path):
    docs = {i: " ".join(WORDS[i % 10 : i % 10 + 3]) for i in range(200)}
    index = TextIndex(spark, f"file://{tmp_path}/i", ("t",), parts=16).build(frame(spark, docs))
    plan = index.lexemes(["agu"])._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters" in plan
    assert "In(stem" in plan or "EqualTo(stem,agu)" in plan
    assert "part#" in plan.split("PartitionFilters")[1].split("\n")[0]


def test_empty_and_null(spark, queries, tmp_path):
    index = TextIndex(spark, f"file://{tmp_path}/i", ("t",)).build(spark.createDataFrame([(None, "agua"), (1, None), (2, "")], "id long, t string"))
    assert index.hits(queries).count() == 0
    assert index.lexemes([]).count() == 0


def test_of_files(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a")
    spark.range(3).write.parquet(f"{tmp_path}/b")
    a, b = (of_files(spark.read.parquet(f"{tmp_path}/{x}")) for x in "ab")
    assert a != b
    assert a == of_files(spark.read.parquet(f"{tmp_path}/a"))
