"""A SparkSession with the settings that the library's results rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "telar", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution on. ``conf``: settings with ``_`` for ``.``, added last."""
    b = SparkSession.builder.appName(app)
    b = b.master(master) if master else b
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for k, v in (settings | {k.replace("_", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()
