"""Writes without a table format: merges that give a new snapshot, and its write.

All joins are on the keys, so one shuffle of both sides (none if both are
bucketed by them); nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"l.`{k}` <=> r.`{k}`" for k in keys))


def latest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key: the first by the given order, which should be total."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__n", n).filter("__n = 1").drop("__n")


def first_wins(old: DataFrame, new: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """Old rows, then new ones whose key is not there yet (of equal new keys, the first by order)."""
    ranked = old.withColumn("__src", F.lit(0)).unionByName(new.withColumn("__src", F.lit(1)), allowMissingColumns=True)
    return latest(ranked, keys, F.col("__src"), *(order or [F.lit(0)])).drop("__src")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """A new row replaces the old one of its key whole; of equal new keys the first by ``order`` counts."""
    new = latest(new, keys, *order) if order else new
    new = new.select(*(F.col(c) if c in new.columns else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in old.columns)).withColumn("__hit", F.lit(True))
    both = old.withColumn("__old", F.lit(True)).alias("l").join(new.alias("r"), _on(old, new, keys), "full_outer")
    return both.select(*(F.when(F.col("r.__hit"), F.col(f"r.`{c}`")).otherwise(F.col(f"l.`{c}`")).alias(c) for c in old.columns))


def partial_update(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, when: Column | None = None, insert: bool = False) -> DataFrame:
    """Only the listed columns change, also to null, in rows whose key is in ``new``; ``when`` (over l.* and r.*) guards.

    ``insert`` adds the keys that ``old`` lacks, with null in the other columns.
    """
    columns = [c for c in (columns or new.columns) if c not in keys]
    new = new.select(*keys, *columns).withColumn("__hit", F.lit(True))
    both = old.withColumn("__old", F.lit(True)).alias("l").join(new.alias("r"), _on(old, new, keys), "full_outer" if insert else "left")
    hit = F.coalesce(F.col("r.__hit"), F.lit(False))
    fresh = F.col("l.__old").isNull()
    change = (hit & F.coalesce(when, F.lit(False)) | fresh) if when is not None else hit
    out = []
    for c in old.columns:
        if c in keys:
            out.append((F.when(fresh, F.col(f"r.`{c}`")).otherwise(F.col(f"l.`{c}`")) if insert else F.col(f"l.`{c}`")).alias(c))
        else:
            out.append(F.when(change, F.col(f"r.`{c}`")).otherwise(F.col(f"l.`{c}`")).alias(c) if c in columns else F.col(f"l.`{c}`"))
    return both.select(*out)


def guarded_update(df: DataFrame, when: Column, values: dict[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE; a null guard changes nothing."""
    hit = F.coalesce(when, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def null_out(df: DataFrame, column: str, keys: DataFrame | None = None, on: str = "id", where: Column | None = None) -> DataFrame:
    """Set a column to null for some keys or rows; refuses to do so for all."""
    if keys is None and where is None:
        raise ValueError("null_out needs keys or a condition")
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    if keys is None:
        return guarded_update(df, hit, {column: F.lit(None).cast(df.schema[column].dataType)})
    marked = df.join(keys.select(F.col(on)).distinct().withColumn("__hit", F.lit(True)), on, "left").withColumn("__hit", F.coalesce("__hit", F.lit(False)) & hit)
    return marked.withColumn(column, F.when(~F.col("__hit"), F.col(column))).select(*df.columns)


def delete_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on), on, "left_anti").select(*df.columns)


def delete_children(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Drop rows whose parent is gone (a foreign key with cascade)."""
    return children.join(parents.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_semi").select(*children.columns)


def deleted_count(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows that delete_keys would remove, by key."""
    return df.join(keys.select(on).distinct(), on, "left_semi").groupBy(on).agg(F.count(F.lit(1)).alias("n_deleted"))


def keys_in_order(df: DataFrame, keys: Sequence[int], on: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the keys in the order asked, keys that are not there). The keys are the caller's own list."""
    spark = df.sparkSession
    asked = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], f"pos int, {on} long")
    return df.join(F.broadcast(asked), on).orderBy("pos").drop("pos"), asked.join(df.select(on), on, "left_anti").orderBy("pos").select(on)


def incremental(df: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """Rows above the highest known key; all rows if none is known."""
    top = known.agg(F.coalesce(F.max(on), F.lit(0)).alias("__top"))
    return df.crossJoin(F.broadcast(top)).filter(F.col(on) > F.col("__top")).drop("__top")  # one row


def transitions(old: DataFrame, new: DataFrame, key: str, state: str) -> DataFrame:
    """How many rows are unchanged, changed, new or unseen, by new state."""
    both = old.select(key, F.col(state).alias("__a"), F.lit(1).alias("__o")).join(new.select(key, F.col(state).alias("__b"), F.lit(1).alias("__n")), key, "full_outer")
    kind = F.when(F.col("__o").isNull(), "new").when(F.col("__n").isNull(), "unseen").when(F.col("__a").eqNullSafe(F.col("__b")), "unchanged").otherwise("changed")
    return both.groupBy(kind.alias("change"), F.coalesce("__b", "__a").alias("state")).agg(F.count(F.lit(1)).alias("n"))


def write_snapshot(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> DataFrame:
    """Write to a new path (never to one that the frame reads) and read it back."""
    w = df.write.option("compression", "snappy")
    (w.partitionBy(*partitions) if partitions else w).parquet(path)
    return df.sparkSession.read.parquet(path)


def fill_missing(df: DataFrame, other: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Null or empty fields filled from the other frame's row of the key; columns that are not there are added."""
    extra = other.select(on, *(F.col(c).alias(f"__{c}") for c in columns))
    both = df.join(extra, on, "left")

    def filled(c: str) -> Column:
        if c not in df.columns:
            return F.col(f"__{c}")
        own = F.col(c)
        blank = own.isNull() | (own == "" if df.schema[c].dataType.typeName() == "string" else F.lit(False))
        return F.when(blank, F.col(f"__{c}")).otherwise(own)

    rest = [c for c in columns if c not in df.columns]
    return both.select(*(filled(c).alias(c) if c in columns else F.col(c) for c in df.columns), *(filled(c).alias(c) for c in rest))


def kept_for(df: DataFrame, written_at: str, now: Column, days: int) -> DataFrame:
    """Entries of a cache that are not older than so many days."""
    return df.filter(F.col(written_at) >= now - F.make_interval(days=F.lit(days)))
