"""Spark session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Applied to every session: result semantics first, then the one setting wide rows need.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # A JSON object with a repeated key keeps the last value instead of failing.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # The JVM never compiles methods above 8,000 bytes of bytecode. Past that size, Spark
    # splits wide projections into small methods, which run compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Defaults for sessions this package builds itself.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "kerbside", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING, **REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a session someone else created."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def assert_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone != "UTC":
        raise ValueError(f"session time zone must be UTC, found {zone}")
