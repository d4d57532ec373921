"""The folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or, in local mode alone (one process), a folder of our own that goes with it."""
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir names no folder that the driver and the executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        own = tempfile.mkdtemp(prefix="telar-")
        atexit.register(shutil.rmtree, own, True)
        _OWN[app] = f"file://{own}"
    return _OWN[app]


def removed(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
