"""The index is written and kept up by blocks: what is shuffled is text once and lists, not a row a word or an entry."""

import random

from pyspark.sql import functions as F

from telar.functions import spanish
from telar.operators import search, text_index
from telar.operators.text_index import TextIndex

WORDS = "servicio servicios sistema sistemas web datos árbol arboles n-12 000000012 7á aguas de la".split()


def frame(spark, docs):
    return spark.createDataFrame(docs, "id long, t string")


def same(index, fresh):
    return {tuple(map(str, r)) for r in index.lexemes().collect()} == {tuple(map(str, r)) for r in fresh.collect()}


def test_written_in_many_tasks_as_listed_at_once(spark, tmp_path, monkeypatch):
    """Also identifiers that come twice in a batch, two words of a stem, and blocks that a batch empties."""
    monkeypatch.setattr(text_index, "TASK_DOCUMENTS", 20)
    monkeypatch.setattr(text_index, "TASK_ENTRIES", 50)
    monkeypatch.setattr(text_index, "SLOT_TASKS", 4)
    rng = random.Random(5)
    docs = [(rng.choice([i, i, -i, i * 10**9]), " ".join(rng.choices(WORDS, k=rng.randint(0, 9)))) for i in range(150)] + [(3, "web sistemas"), (3, "datos"), (None, "web"), (4, None)]
    index = TextIndex(spark, f"file://{tmp_path}/i", ("t",), span=8, parts=4).build(frame(spark, docs))
    assert same(index, search.lexemes(frame(spark, [d for d in docs if d[0] is not None]), "id", ("t",)))
    gone = {d[0] for d in docs if d[0] is not None and (d[0] % 5 == 0 or 40 <= d[0] < 48)}
    index.apply(None, frame(spark, [(g, "") for g in gone]))
    left = search.lexemes(frame(spark, [d for d in docs if d[0] is not None and d[0] not in gone]), "id", ("t",))
    assert same(index, left)
    index.compact()
    assert same(index, left)
    assert index._read(index._commits()).filter(F.size("ids") == 0).count() == 0


def test_tombstones_meet_blocks(spark, tmp_path):
    """Entries were joined with tombstones one by one, which shuffled every entry with its stem."""
    index = TextIndex(spark, f"file://{tmp_path}/i", ("t",)).build(frame(spark, [(1, "agua web"), (2, "agua")]))
    index.apply(None, frame(spark, [(2, "")]))
    plan = index.lexemes()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(") < plan.index("Join LeftOuter")
    assert {(r.stem, r.id) for r in index.lexemes().collect()} == {("agu", 1), ("web", 1)}


def test_words_are_listed_where_their_documents_are(spark, tmp_path):
    """A row a word was shuffled to its stem, then to its document's stem, then to its block."""
    blocks, _ = TextIndex(spark, f"file://{tmp_path}/i", ("t",))._blocks(frame(spark, [(1, "agua web")]))
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_words_that_end_in_a_digit_need_no_steps(spark):
    df = spark.createDataFrame([(w,) for w in ["n12", "7", "áéíóú1", "mente9", "ñandú8", "a٣", "gué", "12os", "sistemas"]], "w string")
    got = spanish.stemmed(df, "w").select("w", "stem", F.expr(spanish.stem_expression("w")).alias("want")).collect()
    assert all(r.stem == r.want for r in got)


def test_tasks_follow_the_documents(spark, tmp_path, monkeypatch):
    """With a fixed number of tasks, the memory of one grew with the table."""
    monkeypatch.setattr(text_index, "TASK_DOCUMENTS", 10)
    docs = spark.range(600).select("id", F.lit("agua").alias("t"))
    blocks, tasks = TextIndex(spark, f"file://{tmp_path}/i", ("t",), span=4)._blocks(docs)
    assert tasks == 60 == blocks.rdd.getNumPartitions()
