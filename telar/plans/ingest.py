"""Ingestion from raw records to a new snapshot, dead letters and metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.operators import classify, merge, quality


@dataclass
class Ingested:
    snapshot: DataFrame
    rejected: DataFrame
    metrics: DataFrame


def ingest(raw: DataFrame, current: DataFrame, incremental: bool | None = None, source_zone: str = "UTC") -> Ingested:
    """raw: payload string. Validate, keep what is new, classify, upsert.

    ``incremental`` None: if there are rows already. Records are validated
    before they are compared with the highest known id, so that invalid ones
    always reach the dead letters. New rows win over old ones.
    """
    valid, rejected = quality.split_valid(raw)
    text = classify.blob(*(F.col(c) for c in ("desObjetoContrato", "desContratacion", "nomObjetoContrato", "nomEntidad")))
    rows = quality.to_contracts(valid, classify.first_category(text), classify.relevance(text), source_zone)
    rows = merge.latest(rows, ["id"], F.col("fecha_publica").desc_nulls_last(), F.col("nro_contratacion"), F.xxhash64(*rows.columns))
    if incremental is None:
        incremental = not current.isEmpty()
    if incremental:
        rows = merge.incremental(rows, current, "id")
    metrics = rows.agg(F.count(F.lit(1)).alias("nuevos"), F.count("categoria_it").alias("con_categoria"), F.count("relevancia_ia").alias("con_relevancia")).crossJoin(rejected.agg(F.count(F.lit(1)).alias("rechazados")))
    return Ingested(merge.upsert(current, rows, ["id"]), rejected, metrics)
