"""Files in and out."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CSV_ROWS = 1000


def first_nonempty(*frames: DataFrame) -> DataFrame:
    """The first source that has rows (a fallback chain); the last if none has."""
    for df in frames[:-1]:
        if not df.isEmpty():
            return df
    return frames[-1]


def read_sidecar(spark: SparkSession, path: str, schema: str, key: str = "id", seq: str | None = None) -> DataFrame:
    """JSON lines where the last line of a key wins: by ``seq`` if the lines carry it, else by file and place in it."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"), F.monotonically_increasing_id().alias("__n"))
    rows = lines.select(F.from_json("value", schema).alias("r"), "__f", "__b", "__n").filter(F.col(f"r.{key}").isNotNull())
    order = [F.desc(f"r.{seq}")] if seq else [F.desc("__f"), F.desc("__b"), F.desc("__n")]
    return rows.withColumn("__k", F.row_number().over(Window.partitionBy(f"r.{key}").orderBy(*order))).filter("__k = 1").select("r.*")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Run logs of ``k=v`` lines, one row a file: kv map<string,string>; a line without ``=`` is ``ts``."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    entry = lambda x: F.struct(F.when(x.contains("="), F.trim(F.substring_index(x, "=", 1))).otherwise("ts").alias("k"), F.trim(F.when(x.contains("="), F.regexp_replace(x, "^[^=]*=", "")).otherwise(x)).alias("v"))
    pairs = F.transform(lines, entry)
    seen = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.when(F.map_contains_key(m, p["k"]) & (p["k"] == "ts"), m).otherwise(F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"]))))
    return text.select("path", seen.alias("kv"))


def read_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Binary files with their digest and whether they are PDF or a web page in disguise."""
    head = F.substring(F.col("content"), 1, 512)
    text = F.lower(F.decode(head, "ISO-8859-1"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), F.coalesce(F.decode(F.substring(F.col("content"), 1, 5), "ISO-8859-1") == "%PDF-", F.lit(False)).alias("is_pdf"), F.coalesce(text.rlike(r"^\s*(<!doctype html|<html)"), F.lit(False)).alias("is_html"), "content")


def attachments(payload: Column) -> Column:
    """An attachment list from JSON: an array, or the first array inside an object."""
    kind = "array<struct<idContratoArchivo: long, idTipoArchivo: int, nombre: string, descripcionMime: string>>"
    inner = F.try_element_at(F.filter(F.map_values(F.from_json(payload, "map<string,string>")), lambda v: F.trim(v).startswith("[")), F.lit(1))
    return F.from_json(F.when(F.trim(payload).startswith("["), payload).otherwise(inner), kind)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, key: str = "id", most_bytes: int = 0) -> bool:
    """CSV with header and byte-order mark, all rows. Only if ``most_bytes`` is given, the newest 1000 rows where all text is larger; returns whether all rows were written."""
    columns = list(columns or df.columns)
    flat = df.select(*(F.to_json(c).alias(c) if df.schema[c].dataType.typeName() in ("array", "struct", "map") else F.col(c).cast("string").alias(c) for c in columns))
    whole = not most_bytes or (flat.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0)))).first()[0] or 0) <= most_bytes
    rows = flat if whole else df.orderBy(F.desc(key)).limit(CSV_ROWS).select(*(F.col(c).cast("string").alias(c) for c in columns))
    first, *rest = columns
    rows.select(*columns).coalesce(1).write.mode("overwrite").option("header", False).csv(path) if not columns else rows.withColumnRenamed(first, "﻿" + first).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return whole


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def summary_lines(row: dict) -> str:
    """A run's summary as ``k=v`` lines."""
    return "\n".join(f"{k}={json.dumps(v, ensure_ascii=False) if isinstance(v, (dict, list)) else v}" for k, v in row.items()) + "\n"
