"""Constraints at write against a row-by-row version."""

import random

import pytest
from pyspark.sql import functions as F

from telar import schema
from telar.operators.constraints import Constraints, enforced, violations

def rules():
    return Constraints(required=["a"], checks={"small": F.col("v") < 8}, unique={"a, b": ["a", "b"], "v": ["v"]}, references={"parent": (["b", "v"], "p", ["x", "y"])})


def brute(rows, existing, parents):
    """Rows are inserted in order; each one against what stands and what came before with its key."""
    out = []
    for i, (a, b, v, n) in enumerate(rows):
        bad = ["a required"] if a is None else []
        bad += ["small"] if v is not None and not v < 8 else []
        for name, of in (("a, b", lambda r: (r[0], r[1])), ("v", lambda r: (r[2],))):
            key = of((a, b, v))
            if None not in key and (any(of(r) == key for r in existing) or any(of(r) == key for r in rows[:i])):
                bad.append(name)
        if b is not None and v is not None and (b, v) not in parents:
            bad.append("parent")
        out.append((n, tuple(bad)))
    return sorted(out)


def test_random(spark):
    rnd, pick = random.Random(2), lambda r, k: r.choice([None, *range(k)])
    rows = [(pick(rnd, 6), pick(rnd, 6), pick(rnd, 60), i) for i in range(120)] + [(1, 1, 5, 120 + i) for i in range(40)]
    old, parents = [(pick(rnd, 6), pick(rnd, 6), pick(rnd, 60)) for _ in range(8)], [(x % 6, x) for x in range(0, 60, 2)] + [(None, 1), (2, 2)]
    schema_ = "a int, b int, v int, n int"
    df, existing, p = spark.createDataFrame(rows, schema_), spark.createDataFrame(old, "a int, b int, v int"), spark.createDataFrame(parents, "x int, y int")
    got = violations(df, rules(), {"p": p}, existing, [F.col("n")])
    assert got.columns == ["a", "b", "v", "n", "violated"]
    assert sorted((r["n"], tuple(r["violated"])) for r in got.collect()) == brute(rows, old, set(parents))
    good, bad = enforced(df, rules(), parents={"p": p}, existing=existing, order=[F.col("n")])
    assert good.columns == df.columns and good.count() + bad.count() == len(rows)


def test_odd(spark):
    """Without an order all rows of a key violate; names that clash; empty batches, parents and rules."""
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (None, "w"), (2, "v")], "k int, `__k0` string")
    own = Constraints(unique={"k": ["k"]}, references={"r": (["k"], "p", ["k"])})
    none = df.limit(0)
    assert {r["__k0"]: r["violated"] for r in violations(df, own, {"p": df.filter("k = 2")}).collect()} == {"x": ["k", "r"], "y": ["k", "r"], "z": [], "w": [], "v": []}
    assert {r["__k0"]: r["violated"] for r in violations(df, own, {"p": none}, existing=none).collect()}["v"] == ["r"]
    assert violations(none, own, {"p": df}, df).collect() == []
    assert [r["violated"] for r in violations(df, Constraints()).collect()] == [[]] * 5
    with pytest.raises(ValueError):
        violations(df, own)


def test_relations(spark):
    c = schema.conform(spark.createDataFrame([(1, "mixto"), (2, "otro"), (2, None), (None, None)], "id long, tdr_tipo_extraccion string"), "contratos")
    _, bad = enforced(c, schema.constraints_of("contratos"))
    assert sorted((r["id"] or 0, tuple(r["violated"])) for r in bad.collect()) == [(0, ("id required",)), (2, ("id",)), (2, ("tdr_tipo_extraccion", "id"))]
    k = schema.conform(spark.createDataFrame([(1, 0), (9, 0)], "contrato_id long, chunk_index short"), "chunks_tdr")
    good, bad = enforced(k, schema.constraints_of("chunks_tdr"), parents={"contratos": c})
    assert [r["contrato_id"] for r in good.collect()] == [1] and bad.first()["violated"] == ["contrato_id of contratos"]
