"""Exact nearest rows by blocks, against V.dot over all pairs."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from telar.functions import vector as V
from telar.operators import nearest, search

NAN = float("nan")


def vectors(n, seed):
    r = random.Random(seed)
    some = [[r.gauss(0, 1) for _ in range(5)] for _ in range(n // 2)]
    odd = [[0.0] * 5, [NAN] + [1.0] * 4, [None] + [1.0] * 4, [1.0, 2.0], [float("inf")] + [1.0] * 4, [1e200] * 5, None, []]
    return some + [[3 * x for x in r.choice(some)] for _ in range(n - n // 2 - len(odd))] + odd  # copies of another length too


def plain(rows, q, k, least):
    unit = lambda c: V.l2_normalize(F.col(c))
    pairs = rows.crossJoin(q).select("query_id", "id", V.dot(unit("v"), unit("query")).alias("similarity"))
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return pairs.filter((F.col("similarity") > least) & ~F.isnan("similarity")).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def test_against_all_pairs(spark, monkeypatch):
    rows = spark.createDataFrame(list(enumerate(vectors(300, 1))) + [(None, [1.0, 0.0, 0.0, 0.0, 0.0])], "id long, v array<double>")
    q = spark.createDataFrame([(str(i), v) for i, v in enumerate(vectors(40, 1) + vectors(40, 2))], "query_id string, query array<double>")
    for values, k, least in ((1 << 20, 10, -1.0), (200, 10, -1.0), (200, 3, 0.4), (200, 1000, 0.0)):
        monkeypatch.setattr(nearest, "BLOCK_VALUES", values)
        got, want = (sorted(map(repr, d.collect())) for d in (search.vector_search_many(rows, q, k, "id", "v", least), plain(rows, q, k, least)))
        assert got == want and got


def test_ties_go_by_id_whatever_its_type(spark):
    rows = spark.createDataFrame([(x, [1.0, 2.0, 0.5]) for x in ("b", "a", "é", "Z", None)], "id string, v array<float>")
    q = spark.createDataFrame([(1, [1.0, 2.0, 0.5])], "query_id long, query array<float>")
    assert [r.id for r in search.vector_search_many(rows, q, 4, "id", "v").orderBy("rank").collect()] == [None, "Z", "a", "b"]


def test_no_rows_or_no_queries(spark):
    rows = spark.createDataFrame([(1, [1.0])], "id long, v array<double>")
    q = spark.createDataFrame([(1, [1.0])], "query_id long, query array<double>")
    assert not search.vector_search_many(rows.limit(0), q, 2, "id", "v").collect() and not search.vector_search_many(rows, q.limit(0), 2, "id", "v").collect()


def test_pairs_are_no_rows_of_a_plan(spark):
    """Pairs made as rows of a nested loop cost a thousand times their multiplication."""
    e = spark.range(100).select(F.col("id").alias("vec_id"), F.array(F.rand(1), F.rand(2)).alias("embedding"))
    df = search.vector_search_many(e, e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), 2)
    assert "NestedLoop" not in df._jdf.queryExecution().toString() and "Cartesian" not in df._jdf.queryExecution().toString()
