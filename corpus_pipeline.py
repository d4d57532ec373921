"""The corpus pipeline: toxicity, near duplicates, decontamination, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telar.llm import simhash, toxicity, wfst, wumanber
from telar.llm.common import free_name, table, written
from telar.llm.queries import vocabulary


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine scores below the threshold."""
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return toxicity.scored(docs, machine, score_col=score).filter(F.col(score) < toxicity.THRESHOLD).drop(score)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near duplicates; rows without an id are chosen among themselves."""
    h = free_name(docs, "h")
    rows, kept = docs.withColumn(h, F.xxhash64("text")), simhash.survivors(docs)
    same = rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows[h] == kept["h"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", h]).drop(h)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a test item occurs."""
    return wumanber.clean(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with input_ids, their number, and whether decoding the ids gives the text back."""
    return wfst.with_ids(docs, vocabulary("piece_bpe_32k.model"), check_col="round_trip").withColumn("n_tokens", F.size("input_ids").cast("long"))


STAGES = [("toxicity", not_toxic), ("simhash_near_dedup", one_of_each), ("benchmark_decontamination", decontaminated), ("sentencepiece", pieces)]

#: SQL has neither the trained machine nor the transducer; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
