"""The document pipeline: pages to text to chunks to vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.operators import chunking, embedding, merge, state


def with_texts(contracts: DataFrame, pages: DataFrame) -> DataFrame:
    """Contracts updated from their pages (id, pagina, texto)."""
    done = state.extracted_pages(pages).withColumn("pdf_procesado", F.lit(True))
    return merge.partial_update(contracts, done, ["id"])


def with_chunks(contracts: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunks plus those of contracts that have none of a source yet."""
    api = chunking.contract_chunks(chunking.pending(contracts, chunks, "api"))
    both = chunks.unionByName(api, allowMissingColumns=True)
    pdf = chunking.document_chunks(chunking.pending(contracts.filter("tdr_texto IS NOT NULL"), chunks, "pdf"), both)
    rows = both.unionByName(pdf, allowMissingColumns=True)
    return rows.withColumn("id", F.coalesce("id", F.xxhash64("contrato_id", "chunk_index")))


def with_vectors(contracts: DataFrame, chunks: DataFrame, embedder: embedding.Embedder, limit: int = 0) -> DataFrame:
    due = embedding.pending(chunks, contracts, limit=limit)
    text = chunking.text_to_embed(F.col("fuente"), F.col("texto"), F.col("chunk_embed_text"))
    return embedding.store(chunks, embedding.embedded(due.select("id", "fuente", "texto", "chunk_embed_text"), text, embedder))
