"""Both halves fused, and the text half ranked once a word."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from telar.operators import search
from telar.plans.hybrid import hybrid


def test_a_word_is_ranked_once_however_many_ask(spark):
    e = spark.range(300).select(F.col("id").alias("vec_id"), F.array(F.rand(1) - 0.5, F.rand(2) - 0.5, F.rand(3) - 0.5).alias("embedding"))
    docs = spark.range(400).select("id", F.expr("trim(concat(repeat('agua ', cast(pmod(xxhash64(id), 9) as int)), repeat('red ', cast(id % 4 as int))))").alias("t"))
    q = e.filter("vec_id % 2 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), F.element_at(F.array(F.lit("agua"), F.lit("red"), F.lit("nada")), (F.col("vec_id") % 3 + 1).cast("int")).alias("word"))
    index = search.postings(docs, "id", ["t"])
    df = hybrid(e, index, q, 5, 7)

    near = search.vector_search_many(e, q, 7).select("query_id", "id", F.col("rank").alias("pos"))
    w = Window.partitionBy("query_id").orderBy(F.desc("tf"), "id")
    text = q.select("query_id", F.col("word").alias("token")).join(index, "token").withColumn("pos", F.row_number().over(w)).filter("pos <= 7").select("query_id", "id", "pos")
    want = search.reciprocal_rank_fusion(near, text, "id", ("query_id",), 5).select("query_id", "id", "rrf", "place")
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(token" in plan and "windowspecdefinition(query_id#" in plan and "tf#" not in "".join(x for x in plan.split("\n") if "windowspecdefinition(query_id" in x)
    assert "LeftSemi" in plan.split("Aggregate [token")[1]  # words that nobody asks for are left out before they are counted
