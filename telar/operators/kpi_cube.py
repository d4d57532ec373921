"""KPIs kept up by changes: a cube of counts that batches move by signed deltas.

A row of the cube counts the records in scope of one line, level, overlay,
state, and local end and publication days: all that the KPIs ask, and nothing that
depends on the day they are asked for. So a batch adds +1 for each new version of
a record and -1 for the version that it replaces, and another day is read from
the same counts. The work of a batch is that of its own records and of the cube, not of
all records; levels are computed for open records alone, as the KPIs need them.

Defined cases: records without an identifier are never replaced; records that come
into or leave the scope count from one side alone; of equal identifiers in a batch the first by
``order`` counts; groups that reach zero are dropped; an empty cube gives zeros and ``[]``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.functions import rubric as R
from telar.functions.time import ZONE, local_date

from . import merge, state

KEYS = ("linea", "rubro", "overlay", "estado", "fin", "pub")


def cube(contracts: DataFrame, sign: int = 1, zone: str = ZONE) -> DataFrame:
    """The groups of these records with n, their number times ``sign``."""
    is_open = F.col("estado") == state.OPEN
    rows = contracts.filter(state.in_scope()).select(
        F.coalesce("categoria_it", F.lit("(sin línea)")).alias("linea"), F.when(is_open, state.rubric_of()).alias("rubro"), F.when(is_open, R.overlay(state.text_of())).alias("overlay"), "estado",
        local_date(F.col("fecha_fin_cotizacion"), zone).alias("fin"), local_date(F.col("fecha_publica"), zone).alias("pub"),
    )
    return rows.groupBy(*KEYS).agg((sign * F.count(F.lit(1))).cast("long").alias("n"))


def changes(replaced: DataFrame, new: DataFrame, zone: str = ZONE) -> DataFrame:
    """The signed groups of a batch from the versions that go and those that come."""
    return cube(replaced, -1, zone).unionByName(cube(new, 1, zone))


def moved(counts: DataFrame, *deltas: DataFrame) -> DataFrame:
    """The cube after the deltas, in any order."""
    for d in deltas:
        counts = counts.unionByName(d)
    return counts.groupBy(*KEYS).agg(F.sum("n").alias("n")).filter("n <> 0")


def upserted(contracts: DataFrame, batch: DataFrame, counts: DataFrame, order: Sequence[Column] = (), zone: str = ZONE) -> tuple[DataFrame, DataFrame]:
    """(records, cube) after a batch of new versions. Write both before the next one.

    Only the batch's identifiers are looked up among the records for the deltas.
    """
    new = merge.latest(batch, ["id"], *order) if order else batch
    replaced = contracts.join(new.select("id"), "id", "left_semi")
    return merge.upsert(contracts, new, ["id"]), moved(counts, changes(replaced, new, zone))


def deleted(contracts: DataFrame, keys: DataFrame, counts: DataFrame, zone: str = ZONE) -> tuple[DataFrame, DataFrame]:
    """(records, cube) without the records of these identifiers."""
    return merge.delete_keys(contracts, keys, "id"), moved(counts, cube(contracts.join(keys.select("id").distinct(), "id", "left_semi"), -1, zone))


def kpis(counts: DataFrame, as_of: str | None = None, zone: str = ZONE) -> DataFrame:
    """As ``state.kpis`` of the records."""
    return state.kpis_of(state.flagged(counts, F.col("estado"), F.col("fin"), F.col("pub"), as_of, zone), F.col("linea"), F.col("rubro"), F.col("n"))


def business_kpis(counts: DataFrame, as_of: str | None = None, zone: str = ZONE) -> DataFrame:
    """As ``state.business_kpis`` of the records."""
    return state.business_kpis_of(state.flagged(counts, F.col("estado"), F.col("fin"), F.col("pub"), as_of, zone), F.col("linea"), F.col("rubro"), F.col("overlay"), F.col("n"))
