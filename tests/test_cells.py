import math
import random

import pytest
from pyspark.sql import functions as F

from telar.operators import search
from telar.operators.cells import CellIndex, recall


@pytest.fixture(scope="module")
def clustered(spark):
    rng = random.Random(3)
    middles = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in middles[min(5, i % 9)]]) for i in range(400)]  # one cluster holds nearly half
    odd = [(1000, [0.0] * 8), (1001, None), (1002, [math.nan] * 8), (1003, [1.0, None] * 4), (1004, [1.0, 2.0]), (7, rows[7][1]), (7, rows[7][1])]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), rows


@pytest.fixture(scope="module")
def index(spark, clustered, tmp_path_factory):
    return CellIndex(spark, f"file://{tmp_path_factory.mktemp('c')}/i").build(clustered[0], cells=12, sample=200)


def brute(rows, query, k):
    unit = lambda v: [x / math.sqrt(sum(y * y for y in v)) for x in v]
    q = unit(query)
    return sorted(((i, sum(a * b for a, b in zip(unit(v), q, strict=True))) for i, v in rows), key=lambda r: (-round(r[1], 9), r[0]))[:k]


def test_exact_without_probes(spark, clustered, index):
    queries = [(i, [x + 0.1 for x in v]) for i, v in clustered[1][::40]] + [(5000, [0.0] * 8), (5001, None)]
    got = index.search(spark.createDataFrame(queries, "query_id long, query array<double>"), 5).collect()
    everything = clustered[1] + [clustered[1][7]] * 2
    for key, q in queries:
        own = sorted((r for r in got if r.query_id == key), key=lambda r: r["rank"])
        want = brute(everything, q, 5) if key < 5000 else []
        assert [round(r.similarity, 9) for r in own] == [round(s, 9) for _, s in want]
        assert {r.id for r in own} == {i for i, _ in want}


def test_opens_few_cells(spark, clustered, index):
    q = spark.createDataFrame([(1, clustered[1][0][1])], "query_id long, query array<double>")
    opened = index.search(q, 5, 1)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(cell" in opened
    assert index.search(q, 5, 1).count() == 5
    assert index.probes_for(0.95, 5) <= 3


def test_recall(spark, tmp_path):
    """Every vector is written, and of the ten nearest of the driver's vectors nine in ten are found in as many cells as were fitted."""
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    index = CellIndex(spark, f"file://{tmp_path}/i").build(e)
    assert index.vectors().count() == e.count()
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    exact = search.vector_search_many(e, q, 10)
    probes = index.probes_for(0.95)
    assert 1 <= probes < 64
    r = recall(index.search(q, 10, probes), exact).agg(F.avg("recall").alias("mean"), F.count("*").alias("n")).first()
    assert r.n == q.count()
    assert r["mean"] >= 0.9


def test_none(spark, tmp_path):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    index = CellIndex(spark, f"file://{tmp_path}/i").build(none)
    q = spark.createDataFrame([(1, [1.0])], "query_id long, query array<double>")
    assert index.search(q).count() == 0
    assert index.search(q, probes=3).count() == 0


def test_cells_are_dealt_and_searched_by_blocks(spark, tmp_path):
    """The cell is that of a nearest centre, and no row is made of each vector and query."""
    from telar.operators.cells import _dealt

    rows = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(2500)], "id long, v array<double>")
    centres = [(4, [0.0, 1.0, 0.0]), (9, [5.0, 1.0, 2.0]), (2, [3.0, 0.0, 1.0])]
    got = _dealt(rows, centres).collect()
    assert len(got) == 2500
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    assert all(far(r.v, dict(centres)[r.cell]) == min(far(r.v, c) for _, c in centres) for r in got)
    index = CellIndex(spark, f"file://{tmp_path}/i").build(rows, "id", "v", cells=3)
    df = index.search(rows.select(F.col("id").alias("query_id"), F.col("v").alias("query")), 2, probes=1)
    assert "FlatMapCoGroupsInArrow" in df._jdf.queryExecution().toString()
