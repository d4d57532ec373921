"""Changes of pages carried on, the stateful quota, and the automaton of keywords."""

import random

import pytest
from pyspark.sql import functions as F

from telar.operators import automaton, classify, embedding, state
from telar.plans import changes
from telar.streaming import quota

RECORD = "id long, entidad string, descripcion string, objeto string, descripcion_contrato string, nro_contratacion string, estado string"
HOW = {"least_chars": 1, "split_over": 0, "target": 1}


def records(spark, n=4):
    return spark.createDataFrame([(i, f"E{i}", "cosas", None, None, str(i), "Vigente") for i in range(n)], RECORD)


def pages(spark, of):
    return spark.createDataFrame([(i, p, t) for i, ts in of.items() for p, t in enumerate(ts)], "id long, pagina int, texto string")


class Counted:
    """An embedder that fails texts with a word; what it got is counted by the rows of its results."""

    def __init__(self, bad=None):
        self.bad, self.inner = bad, embedding.hashing_embedder(8)

    def __call__(self, texts):
        if self.bad and any(self.bad in t for t in texts):
            raise ValueError("refused")
        return self.inner(texts)


def by_contract(df):
    return {r["contrato_id"]: tuple(r)[1:] for r in changes.work(df).collect()}


def test_one_page(spark, tmp_path):
    """One changed page: one contract is chunked, one chunk embedded; other chunks stay as they were."""
    texts = {i: [f"línea {i} {p} con palabras" for p in range(3)] for i in range(4)}
    _, first = changes.propagate(records(spark), pages(spark, texts), changes.empty_chunks(records(spark)), str(tmp_path / "a"), Counted(), **HOW)
    assert by_contract(first) == {i: (6, 0, 6, 0) for i in range(4)}
    _, same = changes.propagate(records(spark), pages(spark, texts), first, str(tmp_path / "b"), Counted("línea"), **HOW)
    assert by_contract(same) == {} and same.count() == 24 and not same.filter("embedding_v2 IS NULL").count()
    texts[2][1] = "otra línea"
    now, third = changes.propagate(records(spark), pages(spark, texts), same, str(tmp_path / "c"), Counted(), **HOW)
    assert by_contract(third) == {2: (6, 5, 1, 0)}
    assert "otra línea" in now.filter("id = 2").first()["tdr_texto"]
    key = lambda df: {(r["contrato_id"], r["chunk_index"]): (r["texto"], tuple(r["embedding_v2"])) for r in df.collect()}
    fresh = changes.propagate(records(spark), pages(spark, texts), changes.empty_chunks(records(spark)), str(tmp_path / "d"), Counted(), **HOW)[1]
    assert key(third) == key(fresh)


def test_removed_failed_and_odd(spark, tmp_path):
    """No pages: no chunks. A failed batch is due the next time. Changed fields change the origin. Other sources and null ids stay out of it."""
    texts = {0: ["una página"], 1: ["dos páginas"], 2: ["mala página"], 3: [None, ""], None: ["sin dueño"]}
    api = changes.empty_chunks(records(spark)).unionByName(spark.createDataFrame([(7, 0, 0, "Metadata", "x", "api")], "id long, contrato_id long, chunk_index int, tipo string, texto string, fuente string"), allowMissingColumns=True)
    own = records(spark).unionByName(spark.createDataFrame([(None, "E", "x", None, None, "n", "Vigente")], RECORD))
    _, first = changes.propagate(own, pages(spark, texts), api, str(tmp_path / "a"), Counted("mala"), **HOW)
    rows = {(r["contrato_id"], r["chunk_index"]) for r in first.collect()}
    assert rows == {(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1)}  # 0 counts on from its chunk of the other source
    assert by_contract(first)[2][3] >= 1
    del texts[1]
    own = own.withColumn("entidad", F.when(F.col("id") == 0, "Otra").otherwise(F.col("entidad")))
    _, later = changes.propagate(own, pages(spark, texts), first, str(tmp_path / "b"), Counted(), **HOW)
    assert by_contract(later) == {0: (2, 0, 2, 0)}  # 2 was embedded, not chunked anew
    assert {r["contrato_id"] for r in later.collect()} == {0, 2}
    assert later.filter("embedding_v2 IS NULL").select("fuente").collect() == [("api",)]
    _, none = changes.propagate(own.limit(0), pages(spark, {0: ["x"]}).limit(0), later, str(tmp_path / "c"), Counted(), **HOW)
    assert [r["fuente"] for r in none.collect()] == ["api"]


def test_recognised(spark, tmp_path):
    """Images are read once; what the reader fails stays due, pages with text never reach it."""
    p = pages(spark, {1: ["texto largo " * 10, "", None], 2: ["", "x"]}).withColumn("leida", (F.col("id") == 2) & (F.col("pagina") == 1))

    def read(keys):
        if (1, 2) in keys:
            raise ValueError("no image")
        return [f"leído {i} {n}" if i == 1 else None for i, n in keys]

    got = {(r["id"], r["pagina"]): (r["texto"], r["leida"]) for r in changes.recognised(p, read, batch=1).collect()}
    assert got == {(1, 0): ("texto largo " * 10, False), (1, 1): ("leído 1 1", True), (1, 2): (None, False), (2, 0): ("", False), (2, 1): ("x", True)}


def run_stream(spark, folder, rows, **how):
    schema = "k string, ts timestamp, id long, cost double, status int, `_x` int"
    spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{folder}/in")
    with quota.state_store(spark):
        kept = quota.planned_calls(spark.readStream.schema(schema).parquet(f"{folder}/in"), ["k"], "ts", "id", "cost", how.pop("budget", 10.0), "status", **how)
        kept.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def at(minutes):
    import datetime

    return datetime.datetime(2024, 5, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(minutes=minutes)


def test_quota_equals_batch(spark, tmp_path):
    """Random calls in two deliveries with a restart between them: as in one batch, days ending at local midnight."""
    rnd = random.Random(5)
    calls = sorted((at(rnd.randrange(3 * 24 * 60)), i, f"k{rnd.randrange(3)}", rnd.choice([0.5, 1.0, None])) for i in range(300))
    rows = [(k, ts, i, c, 200, i) for ts, i, k, c in calls]
    run_stream(spark, tmp_path, rows[:170])
    got = {r["id"]: (r["running"], r["planned"], r["_x"]) for r in run_stream(spark, tmp_path, rows[170:]).collect()}
    whole = spark.createDataFrame(rows, "k string, ts timestamp, id long, cost double, status int, x int").withColumn("cost", F.coalesce("cost", F.lit(0.0)))
    whole = whole.withColumn("day", F.to_date(F.from_utc_timestamp("ts", "America/Lima")))
    want = {r["id"]: (r["running"], r["planned"], r["x"]) for r in state.planned(whole, "cost", 10.0, ["k", "day"], F.col("ts"), F.col("id")).collect()}
    assert got == want and {p for _, p, _ in got.values()} == {True, False}


def test_backoff_and_late(spark, tmp_path):
    """A refusal makes calls wait, the next one twice as long, a success ends it; a closed day's call is late; null keys are a key."""
    rows = [(None, at(0), 1, 1.0, 429, 0), (None, at(0.5), 2, 1.0, 200, 0), (None, at(1), 3, 1.0, 429, 0), (None, at(2.5), 4, 1.0, 200, 0), (None, at(3), 5, 1.0, 200, 0), (None, at(4), 6, 1.0, 429, 0), (None, at(5), 7, 1.0, 200, 0), (None, None, 8, 1.0, 200, 0)]
    run_stream(spark, tmp_path, rows, first_wait=60.0)
    got = run_stream(spark, tmp_path, [(None, at(3 * 24 * 60), 9, 1.0, 200, 0)], first_wait=60.0)
    assert {r["id"]: r["reason"] for r in got.collect()} == {1: None, 2: "backoff", 3: None, 4: "backoff", 5: None, 6: None, 7: None, 9: None}
    got = run_stream(spark, tmp_path, [(None, at(6), 10, 1.0, 200, 0), (None, at(3 * 24 * 60 + 5), 11, 1.0, 200, 0)], first_wait=60.0)
    last = {r["id"]: (r["running"], r["reason"]) for r in got.collect()}
    assert last[11] == (2.0, None) and last.get(10, (None, "late")) == (None, "late")


def test_automaton(spark):
    """Against the expressions, keyword by keyword, on random texts of pieces of keywords."""
    rnd, every = random.Random(3), automaton.every_term(classify.CATEGORIES, classify.STRONG, classify.GENERIC, classify.GENERIC_WIDE, classify.WHOLE_WORDS)
    pieces = [t for t in every for _ in range(2)] + ["ia", "ia_", "á", "9", "x", "", "٣", "²"]
    texts = [None, "", " ", "ia", "señal ia.", "historia", "ia9 ia"] + ["".join(rnd.choice(pieces) + rnd.choice([" ", "", "  ", "."]) for _ in range(rnd.randrange(8))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("hits", automaton.found(F.col("t"), every))
    got = df.select("i", "hits", automaton.first_category(F.col("hits")).alias("c"), automaton.relevance(F.col("hits"), none="B").alias("r"), automaton.detected(F.col("hits")).alias("d"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    want = df.select("i", classify.found_terms(F.col("t"), every).alias("hits"), classify.first_category(F.col("t")).alias("c"), classify.relevance(F.col("t"), none="B").alias("r"), classify.detected(F.col("t")).alias("d"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError):
        automaton.found(F.col("t"), ["a", ""])
    assert spark.range(1).select(automaton.found(F.lit("a"), []).alias("h")).first()["h"] == []
