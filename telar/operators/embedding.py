"""The life of embeddings. Models are plugged in; a hashing one stands in offline."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.functions.vector import l2_normalize
from .merge import partial_update

Embedder = Callable[[list[str]], list[list[float]]]


class _Places(dict):
    """Of words, found at the first time; those of the negative sign come after the others."""

    def __init__(self, dimension: int):
        self.dimension = dimension

    def __missing__(self, word: str) -> int:
        h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        self[word] = place = h % self.dimension + (0 if h >> 63 else self.dimension)
        return place


def hashing_embedder(dimension: int = 64, known_words: int = 1 << 18) -> Embedder:
    """Deterministic: words hashed to signed dimensions. A task keeps the places of some ``known_words`` words, so that one is seldom hashed twice."""
    places = _Places(dimension)

    def embed(texts: list[str]) -> list[list[float]]:
        if len(places) > known_words:
            places.clear()
        words = [t.lower().split() for t in texts]
        at = np.repeat(np.arange(len(texts)) * (2 * dimension), [len(ws) for ws in words])
        at += np.fromiter(map(places.__getitem__, chain.from_iterable(words)), np.int64, len(at))
        n = np.bincount(at, minlength=2 * dimension * len(texts)).reshape(len(texts), 2, dimension)
        return (n[:, 0] - n[:, 1]).astype(float).tolist()

    return embed


def pending(chunks: DataFrame, contracts: DataFrame | None = None, column: str = "embedding_v2", source: str | None = None, ids: DataFrame | None = None, limit: int = 0) -> DataFrame:
    """Chunks without a vector, of open contracts if those are given; by id, at most ``limit`` unless 0."""
    due = chunks.filter(F.col(column).isNull())
    due = due.filter(F.col("fuente") == source) if source else due
    if contracts is not None:
        due = due.join(contracts.filter("estado = 'Vigente'").select(F.col("id").alias("contrato_id")), "contrato_id", "left_semi")
    due = due.join(ids.select("contrato_id"), "contrato_id", "left_semi") if ids is not None else due
    return due.orderBy("id").limit(limit) if limit else due


def embedded(rows: DataFrame, text: Column, embedder: Embedder, batch: int = 16, retries: int = 3, pause: float = 0.0, where: Column | None = None) -> DataFrame:
    """The rows with ``vector`` (unit length; null if its batch failed for good) and ``error``. Texts alone go to Python, the rest of a row stays.

    ``where``: the rows to embed, if not all; the others have neither vector nor error, and no batch holds them.
    """

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in arrays:
            texts = a.to_pylist()
            asked = [k for k, t in enumerate(texts) if t is not None]
            made, errors = [None] * len(texts), [None] * len(texts)
            for at in range(0, len(asked), batch):
                rows_of = asked[at : at + batch]
                some = [texts[k] for k in rows_of]
                vectors, error = None, None
                for attempt in range(retries):
                    try:
                        vectors = embedder(some)
                        if len(vectors) != len(some):
                            raise ValueError(f"{len(vectors)} vectors for {len(some)} texts")
                        error = None
                        break
                    except (TypeError, NameError, AttributeError):
                        raise  # a fault of the program, not of the model
                    except Exception as e:  # a batch's failure is a result, not the job's
                        vectors, error = None, f"{type(e).__name__}: {e}"
                        time.sleep(pause * 2**attempt)
                for i, k in enumerate(rows_of):
                    made[k], errors[k] = None if vectors is None else vectors[i], error
            yield pa.StructArray.from_arrays([pa.array(made, pa.list_(pa.float64())), pa.array(errors, pa.string())], names=["vector", "error"])

    once = F.arrow_udf(run, "vector array<double>, error string").asNondeterministic()  # so that no filter asks the model again
    text = F.coalesce(text, F.lit(""))
    return rows.withColumn("__made", once(text if where is None else F.when(where, text))).withColumns({"vector": l2_normalize(F.col("__made.vector")), "error": F.col("__made.error")}).drop("__made")


def store(chunks: DataFrame, vectors: DataFrame, column: str = "embedding_v2") -> DataFrame:
    """Chunks with the new vectors that did not fail."""
    new = vectors.filter("vector IS NOT NULL").select("id", F.col("vector").cast("array<float>").alias(column))
    return partial_update(chunks, new, ["id"])


def coverage(chunks: DataFrame, contracts: DataFrame, column: str = "embedding_v2") -> DataFrame:
    """Chunks of open contracts with and without a vector, by source."""
    own = chunks.join(contracts.filter("estado = 'Vigente'").select(F.col("id").alias("contrato_id")), "contrato_id", "left_semi")
    return own.groupBy("fuente").agg(F.count(F.lit(1)).alias("n"), F.count(column).alias("with_vector"), F.countDistinct("contrato_id").alias("n_contracts"))


def better_mode(header: float | None, body: float | None, tie: float = 0.01) -> str:
    """Of two texts to embed, the one whose vectors lie further apart (lower mean cosine); body on a tie."""
    if header is None or body is None:
        return "body"
    return "header" if header < body - tie else "body"


def compare_modes(rows: DataFrame, texts: dict[str, Column], embedder: Embedder, group: str) -> DataFrame:
    """Mean pairwise cosine of a group's vectors by the way its texts are made (mode)."""
    from functools import reduce

    from .search import mean_pairwise

    parts = (mean_pairwise(embedded(rows.select("*"), text, embedder).filter("vector IS NOT NULL"), [group], "vector").withColumn("mode", F.lit(mode)) for mode, text in texts.items())
    return reduce(DataFrame.unionByName, parts)
