"""Streams (an extension: the batch operators' nearest relatives over unbounded input)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telar.operators import merge


def events(spark: SparkSession, path: str, schema: str, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """A file stream with its zone-less time cast to an instant, and a watermark."""
    rows = spark.readStream.schema(schema).parquet(path)
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def once(stream: DataFrame, *keys: str) -> DataFrame:
    """Repeats within the watermark dropped."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def windowed(stream: DataFrame, size: str, *keys: str, ts: str = "ts", value: str = "value") -> DataFrame:
    """Counts and sums by window and keys; also of a batch frame."""
    return stream.groupBy(F.window(ts, size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def rejects(stream: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    from telar.operators.quality import rejected_by

    marked = rejected_by(stream, checks)
    return marked.filter(F.size("errors") == 0).drop("errors"), marked.filter(F.size("errors") > 0)


def merge_sink(stream: DataFrame, snapshot: Callable[[], DataFrame], publish: Callable[[DataFrame, int], None], keys: list[str], order: list[Column], checkpoint: str):
    """foreachBatch upserts: each batch makes a snapshot under its own number, so a replayed batch writes the same."""

    def run(batch: DataFrame, number: int) -> None:
        publish(merge.upsert(snapshot(), merge.latest(batch, keys, *order), keys), number)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
