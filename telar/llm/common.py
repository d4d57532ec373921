"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, in local mode alone, one of our own where that is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master, app = spark.sparkContext.master, spark.sparkContext.applicationId
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir names no folder that the driver and the executors share")
    if app not in _OWN:
        own = tempfile.mkdtemp(prefix="telar-")
        atexit.register(shutil.rmtree, own, True)
        _OWN[app] = f"file://{own}"
    return _OWN[app]


def run_dir(spark: SparkSession) -> str:
    """The part of the shared folder that this application writes to."""
    return f"{shared_dir(spark)}/telar/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a table in the shared folder: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def removed(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once nothing reads them any more."""
    for t in tables:
        removed(t.sparkSession, t.written_to)


def clear(spark: SparkSession) -> None:
    """Delete all that this application's operators wrote to the shared folder; their results can't be read after that."""
    removed(spark, run_dir(spark))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    while name in df.columns:
        name = f"_{name}"
    return name


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the key written as text, modulo n; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def bounded(df: DataFrame) -> DataFrame:
    """Rows go to Python in batches of at most BATCH_BYTES (a row more), whatever the length of texts."""
    conf = df.sparkSession.conf
    size = re.fullmatch(r"(\d+)([kmg]?)b?", conf.get(_BATCH).lower())
    if not size or not 0 < int(size[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[size[2]] <= BATCH_BYTES:
        conf.set(_BATCH, str(BATCH_BYTES))
    return df


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow by one function of a batch; it gives a batch with the schema's columns, or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return bounded(df).mapInArrow(run, schema)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    col = batch.column(name)
    return [x or b"" for x in col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()]


def arrow_fs(uri: str):
    """(file system, path) of a Hadoop-style URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)
