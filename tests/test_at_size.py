"""Steps that were one task's work, or a frame's copy a batch, or made again what stands already."""

import random
import re

from pyspark.sql import functions as F

from telar import catalog, catalog_more
from telar.functions import text as T
from telar.operators import chunking, embedding
from telar.plans import changes
from telar.sources import captured


def test_a_stream_reads_as_many_files_as_there_are_parts(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 400, 1, 4).select((F.col("id") % 90).alias("l_orderkey"), F.col("id").cast("int").alias("l_linenumber"), F.col("id").alias("l_partkey"), F.lit(1).alias("l_suppkey"), F.lit(1.0).alias("l_quantity"), F.lit(2.0).alias("l_extendedprice"), F.lit("R").alias("l_returnflag"))
    rows.write.parquet(f"{tmp_path}/sf/lineitem.parquet")
    monkeypatch.setattr(catalog_more, "_folder", lambda _: f"file://{tmp_path}/files")
    monkeypatch.setattr(catalog_more, "table", lambda *_: rows)
    got = {r.id: r.l_linenumber for r in catalog.QUERIES["merged_stream"](spark, f"{tmp_path}/sf").collect()}
    assert got == {k: max(range(k, 400, 90)) for k in range(90)}
    assert len(list((tmp_path / "files" / "in").glob("*.parquet"))) == 4


def test_pages_are_numbered_without_dealing_rows_by_object(spark, tmp_path):
    rows = spark.range(0, 300, 1, 3).select("id", F.lit("en").alias("lang"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = captured.paged(rows, "id", 100, f"file://{tmp_path}/p", "lang")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(objeto" not in plan.split("BroadcastHashJoin")[0] and "SortMergeJoin" not in plan
        assert {(r.page, r["count"]) for r in df.groupBy("page").count().collect()} == {(1, 100), (2, 100), (3, 100)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_batches_fail_each_for_itself(spark):
    def some(texts):
        if "3" in texts:
            raise ValueError("no")
        return [[float(x or 0) + 1] for x in texts]

    rows = spark.range(0, 10, 1, 1).select("id", F.when(F.col("id") != 5, F.col("id").cast("string")).alias("t"))
    for batch, bad in ((1, {3}), (2, {2, 3}), (16, set(range(10)))):
        got = embedding.embedded(rows, F.col("t"), some, batch=batch, retries=1).collect()
        assert {r.id for r in got if r.vector is None and r.error == "ValueError: no"} == bad
        assert all(r.vector == [1.0] and r.error is None for r in got if r.id not in bad) and len(got) == 10


CONTRACT = "id long, entidad string, descripcion string, objeto string, descripcion_contrato string, nro_contratacion string, tdr_texto string"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_text_is_cut_once_and_its_headers_are_made_once(spark, tmp_path):
    rows = [(1, "Caja Uno", "cosas", None, None, "n1", " a b\r\n\n\tc\u00a0\n" + "x" * 50), (2, "E", None, None, "t] u", "n2", "\u2003 [k]\n d"), (3, "E", None, None, "t]", None, "y"), (4, None, "z", None, None, None, " \n\u3000")]
    spark.createDataFrame(rows, CONTRACT).write.parquet(str(tmp_path / "c"))
    contracts = spark.read.parquet(str(tmp_path / "c"))
    made = chunking.document_chunks(contracts, split_over=0, target=4)
    above, below = plan(made).split("Generate")
    assert below.count("aggregate(") == 1 and "aggregate(" not in above
    assert "upper(" not in above and "regexp_extract_all" not in above
    got = {(r.contrato_id, r.chunk_index): r for r in made.collect()}
    assert {k: v.texto for k, v in got.items()} == {(1, 0): "[CU | n1]\na b\nc", (1, 1): "[CU | n1]\n" + "x" * 50, (2, 0): "[E | t] u]\n[k]\nd", (3, 0): "[E | t]]\ny"}
    own = made.join(contracts.select(F.col("id").alias("contrato_id"), "entidad", "descripcion", "objeto"), "contrato_id")
    same = chunking.embed_text(F.col("entidad"), F.col("descripcion"), F.col("objeto"), F.col("meta_nro"), F.col("texto"))
    assert own.filter(~same.eqNullSafe(F.col("chunk_embed_text"))).count() == 0
    lines = chunking.document_chunks(contracts, split_over=0, target=1).collect()
    assert [r.texto.split("\n", 1)[1] for r in sorted(lines, key=lambda r: (r.contrato_id, r.chunk_index))] == ["a b", "c", "x" * 50, "[k]", "d", "y"]


def test_texts_alone_go_to_python(spark):
    rows = spark.range(0, 10, 1, 1).select("id", F.col("id").cast("string").alias("t"), F.lit("x").alias("long"))
    made = embedding.embedded(rows, F.col("t"), lambda texts: [[float(t)] for t in texts if float(t) % 2 or 1 / 0], batch=3, where=F.col("id") % 2 == 1)
    assert "MapInPandas" not in plan(made) and re.search(r"ArrowEvalPython", plan(made))
    assert {r.id: r.vector for r in made.filter("vector IS NOT NULL").collect()} == {i: [1.0] for i in range(1, 10, 2)}
    assert made.filter("error IS NOT NULL").count() == 0 and made.count() == 10


def test_known_words_do_not_change_vectors():
    texts = ["a b a c", "", "b  B\nd", "e f g h a"]
    forgetful = embedding.hashing_embedder(4, known_words=1)
    assert [forgetful([t])[0] for t in texts] == embedding.hashing_embedder(4)(texts) and forgetful([]) == []


def test_first_chunks_meet_no_former_vectors_and_texts_are_not_dealt_out_again(spark, tmp_path):
    """What is written at first holds what it has to; a second run with nothing changed asks for no text."""
    records = spark.createDataFrame([(i, "E", "d", None, None, str(i), "Vigente") for i in range(6)], "id long, entidad string, descripcion string, objeto string, descripcion_contrato string, nro_contratacion string, estado string")
    pages = spark.createDataFrame([(i, p, f"línea {i} {p}") for i in range(6) for p in range(2)], "id long, pagina int, texto string")
    how = {"least_chars": 1, "split_over": 0, "target": 1}
    now, first = changes.propagate(records, pages, changes.empty_chunks(records), str(tmp_path / "a"), embedding.hashing_embedder(4), **how)
    assert not [c for c in now.columns if c.startswith("__")]
    _, same = changes.propagate(now, pages, first, str(tmp_path / "b"), embedding.hashing_embedder(4), **how)
    moved = spark.read.parquet(str(tmp_path / "b" / "moved"))
    assert moved.count() == 0 and changes.work(same).count() == 0 and same.count() == 24
    assert spark.read.parquet(str(tmp_path / "b" / "contracts")).filter("__moved").count() == 0


def test_text_functions_equal_their_expressions(spark):
    every = spark.createDataFrame([(chr(i),) for i in range(0x10000) if not 0xD800 <= i < 0xE000], "c string")  # white space is all there
    assert every.filter((T.strip(F.col("c")) == "") != (F.regexp_replace("c", r"(?U)^\s+|\s+$", "") == "")).count() == 0
    assert every.filter(T.strip(F.col("c")) == "").count() == len(T.SPACE)
    rnd, pieces = random.Random(4), ["\u0000", " ", "\t", "\n", "\n", "\r", "\u2003", "\u00a0", "a", "é", "9", "𝐀", ".", "-"]
    texts = [None, ""] + ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(14))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    old = F.col("t")
    for pattern, by in (("\u0000", " "), (r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n"), (r"[ \t]{2,}", " "), (r"(?U)^\s+|\s+$", "")):
        old = F.regexp_replace(old, pattern, by)
    assert df.filter(~T.clean_text(F.col("t")).eqNullSafe(old)).count() == 0
    for n in (0, 1, 3, 101):
        assert df.filter(T.fewer_useful(F.col("t"), n) != (T.useful_chars(F.col("t")) < n)).count() == 0
