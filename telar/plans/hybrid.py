"""Hybrid search: vector hits and text hits of a query set, fused."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telar.operators import search
from telar.operators.text_index import TextIndex


def hybrid(rows: DataFrame, index: DataFrame, queries: DataFrame, k: int = 10, each: int = 20, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, id, rrf, place. queries: query_id, query (vector), word (one search word). index: token, id, tf."""
    near = search.vector_search_many(rows, queries, each, id_col, vector).select("query_id", "id", F.col("rank").alias("pos"))
    terms = queries.select("query_id", F.col("word").alias("token"))
    w = Window.partitionBy("token").orderBy(F.desc("tf"), "id")
    best = index.join(search.asked(terms.select("token").distinct()), "token", "left_semi").withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= each)  # once a word, however many queries ask for it
    text = best.join(search.asked(terms), "token").select("query_id", "id", "pos")
    return search.reciprocal_rank_fusion(near, text, "id", ("query_id",), k).select("query_id", "id", "rrf", "place")


def hybrid_records(chunks: DataFrame, records: DataFrame, index: DataFrame | TextIndex, queries: DataFrame, k: int = 10, each: int = 20, min_similarity: float = 0.2, vector: str = "embedding_v2", state: str | None = "Vigente") -> DataFrame:
    """query_id, id (of a record), rrf, place: the records of the ``each`` nearest chunks, by their first one, fused with the ``each`` best by text.

    queries: query_id, query (vector), term. chunks: id, contrato_id and a vector. index: lexemes of the records, or their written index.
    """
    own = records if state is None else records.filter(F.col("estado") == state)
    open_chunks = chunks.join(own.select(F.col("id").alias("contrato_id")), "contrato_id", "left_semi")
    near = search.vector_search_many(open_chunks, queries.select("query_id", "query"), each, "id", vector, min_similarity)
    near = near.join(open_chunks.select("id", "contrato_id"), "id").select("query_id", F.col("contrato_id").alias("id"), "rank")
    near = search.first_hits(near, ["query_id"], "id", F.col("rank")).select("query_id", "id", "pos")
    how = queries, each, [F.col("fecha_publica").desc_nulls_last()], own.select("id", "fecha_publica")
    text = index.hits(*how) if isinstance(index, TextIndex) else search.spanish_hits(index, *how)
    text = queries.select("query_id", "term").join(text.select("term", "id", "pos"), "term").select("query_id", "id", "pos")
    return search.reciprocal_rank_fusion(near, text, "id", ("query_id",), k).select("query_id", "id", "rrf", "place")
