"""Answers of a paged source kept as a table, from which it can be read again.

Pages are made without one task that sees all rows: rows are ranged by their
order and written, and a row's place follows from its place in its own partition
and the number of rows in those before it. Answers are Parquet rows sorted by
object and page in row groups of a megabyte, so a request reads one group.

Defined cases: a null object is the empty one; equal ids are all kept, in any order;
no rows give no pages, and a request then gets an answer without records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP_BYTES = 1 << 20


def paged(rows: DataFrame, key: str, size: int, folder: str, by: str | None = None) -> DataFrame:
    """The rows with ``objeto`` (the value of ``by`` as text), ``page`` (from 1, ids falling), ``pages`` and ``total`` of their object."""
    objeto = F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")
    order = [F.col("objeto").asc(), F.col(key).desc_nulls_last()]
    ranged = rows.withColumn("objeto", objeto).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("__at", F.monotonically_increasing_id()).write.parquet(folder)
    kept = rows.sparkSession.read.parquet(folder)
    kept = kept.withColumn("__part", F.shiftright("__at", 33)).withColumn("__at", F.col("__at").bitwiseAND((1 << 33) - 1))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    parts = kept.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    placed = kept.join(F.broadcast(parts), "__part").withColumn("__at", F.col("__at") + F.col("__before")).drop("__part", "__before")
    firsts = placed.groupBy("objeto").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("total"))
    page = F.floor((F.col("__at") - F.col("__first")) / size).cast("int") + 1
    pages = F.ceil(F.col("total") / size).cast("int")
    # a row an object: were the rows dealt by object to be joined, one task would read all of an object
    return placed.join(F.broadcast(firsts), "objeto").withColumn("page", page).withColumn("pages", pages).drop("__first", "__at")


def answers(numbered: DataFrame, key: str, body: Column) -> DataFrame:
    """objeto, page, body: one answer a page. ``body`` is made of ``rows``, the page's rows (at most a page's size) as structs with ids falling, ``pages`` and ``total``."""
    fields = [c for c in numbered.columns if c not in ("objeto", "page", "pages", "total")]
    rows = F.collect_list(F.struct(F.col(key).alias("__key"), *fields))
    of_page = numbered.groupBy("objeto", "page").agg(rows.alias("rows"), F.first("pages").alias("pages"), F.first("total").alias("total"))
    return of_page.withColumn("rows", F.reverse(F.array_sort("rows"))).select("objeto", "page", body.alias("body"))


def write_pages(bodies: DataFrame, folder: str) -> str:
    """Keep answers (objeto, page, body) for ``rest.CapturedPages``; returns the folder."""
    order = ["objeto", "page"]
    bodies.select(*order, "body").repartitionByRange(*order).sortWithinPartitions(*order).write.option("parquet.block.size", GROUP_BYTES).parquet(folder)
    return folder
