"""Each query beside its SQL in DuckDB, at the smallest scale."""

import datetime
import decimal
import glob
import math
import os
import subprocess
import sys

import duckdb
import pytest

from telar import catalog

from .conftest import ROOT

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert rows or name in ("opportunity_score_topk",)
    if name in catalog.SQL:
        r = db.sql(catalog.SQL[name])
        assert sorted(r.columns) == cols
        at = [r.columns.index(c) for c in cols]
        assert rows == sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(catalog.QUERIES) <= set(e.queries())


@pytest.mark.parametrize("module", ["telar.catalog", "telar.catalog_records", "telar.catalog_more", "telar.catalog_changes"])
def test_each_module_of_queries_loads_first(module):
    """An executor loads the module whose function it is sent, and no other before it."""
    subprocess.run([sys.executable, "-c", f"import {module}"], check=True, cwd=ROOT)
