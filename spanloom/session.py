"""Sessions and the settings that this library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; further settings by keyword, dots written as double underscores."""
    builder = SparkSession.builder.appName("spanloom")
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
