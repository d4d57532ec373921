"""Coverage and extraction reports, each one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Price of a million prompt and output tokens.
USD_PER_MILLION = (0.50, 3.00)


def counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row of counts; a null condition does not count."""
    return df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()))


def by_label(df: DataFrame, label: Column, name: str, null: str = "NULL") -> DataFrame:
    """Counts by a label, null and empty shown as ``null``, most first."""
    return df.groupBy(F.coalesce(F.nullif(label.cast("string"), F.lit("")), F.lit(null)).alias(name)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name)


def source_coverage(rows: DataFrame, key: str, source: str, sources: tuple[str, str]) -> DataFrame:
    """Keys that have the one source, the other, both, only one."""
    a, b = sources
    per = rows.groupBy(key).agg(F.bool_or(F.col(source) == a).alias("a"), F.bool_or(F.col(source) == b).alias("b"))
    a_, b_ = F.coalesce("a", F.lit(False)), F.coalesce("b", F.lit(False))
    return per.agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(a_).alias(f"with_{a}"), F.count_if(b_).alias(f"with_{b}"), F.count_if(a_ & b_).alias("with_both"), F.count_if(a_ & ~b_).alias(f"only_{a}"), F.count_if(b_ & ~a_).alias(f"only_{b}"))


def extraction_report(contracts: DataFrame) -> DataFrame:
    """Documents by type of extraction, and pages of those that have a document."""
    has = F.coalesce(F.col("req_url"), F.lit("")) != "sin_pdf"
    kind = lambda k: F.count_if(F.coalesce(F.col("tdr_tipo_extraccion") == k, F.lit(False))).alias(k)
    pages = lambda c: F.coalesce(F.sum(F.when(has, F.col(c))), F.lit(0)).cast("long").alias(c)
    return contracts.agg(
        F.count(F.lit(1)).alias("n"), kind("nativo_puro"), kind("mixto"), kind("imagen_total"), F.count_if(~has).alias("sin_pdf"), F.count_if(F.col("req_url") == "pendiente_ocr").alias("pendiente_ocr"), pages("tdr_n_paginas"), pages("tdr_n_paginas_nativas"), pages("tdr_n_paginas_ocr"),
    )


def max_or(df: DataFrame, column: str, empty: int = 0) -> DataFrame:
    return df.agg(F.coalesce(F.max(column), F.lit(empty)).alias(column))


def cost(prompt: Column, output: Column, usd_per_million: tuple[float, float] = USD_PER_MILLION) -> Column:
    return (prompt * usd_per_million[0] + output * usd_per_million[1]) / 1e6


def daily_quota(calls: DataFrame, ts: str, prompt: str, output: str, usd_per_million: tuple[float, float] = USD_PER_MILLION, zone: str = "America/Lima") -> DataFrame:
    """Per local day: calls, tokens, cost."""
    from telar.functions.time import local_date

    return calls.groupBy(local_date(F.col(ts), zone).alias("dia")).agg(F.count(F.lit(1)).alias("requests"), F.sum(prompt).alias("prompt_tokens"), F.sum(output).alias("output_tokens"), F.sum(cost(F.col(prompt), F.col(output), usd_per_million)).alias("usd"))
