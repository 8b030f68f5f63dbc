"""The Spark session that the operators expect: UTC, ANSI, adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.sources.partitionOverwriteMode": "dynamic", "spark.sql.parquet.compression.codec": "zstd"}


def session(name: str = "tideline", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (SETTINGS | settings).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
