"""Raw messages from Kafka or JSON lines, and the landing zone they end up in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.schemas import (
    FAMILY_FOR,
    LANDING,
    PRESENCE_EVENT_TYPES,
    TOPIC_PRESENCE,
    TOPIC_TRIPS,
)


def read_raw_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Both event topics from the earliest offset; the checkpoint commits after the write.

    Needs the Kafka connector on the classpath. Everything downstream takes any DataFrame of
    this shape.
    """
    settings = {
        "subscribe": ",".join(FAMILY_FOR),
        "startingOffsets": "earliest",
        # A batch starts at 10,000 messages or after 60 seconds, and takes all there is.
        "minOffsetsPerTrigger": "10000",
        "maxTriggerDelay": "60s",
        "includeHeaders": "true",
        "failOnDataLoss": "true",
        **options,
    }
    stream = spark.readStream.format("kafka").options(**settings).load()
    return stream.select("key", "value", "topic", "partition", "offset", "headers")


def _routed_topic(event_type) -> F.col:
    return F.when(event_type.isin(*PRESENCE_EVENT_TYPES), TOPIC_PRESENCE).otherwise(TOPIC_TRIPS)


def read_events_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines files in the raw message shape, one message per line."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    event_type = F.get_json_object("value", "$.event_type")
    key = F.get_json_object("value", "$.partition_key")
    return lines.select(
        key.cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        _routed_topic(F.coalesce(event_type, F.lit(""))).alias("topic"),
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
    )


def read_landing(spark: SparkSession, path: str, family: str | None = None) -> DataFrame:
    """The landing zone with its declared schema; columns older files lack read as NULL."""
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in LANDING])
    rows = spark.read.schema(nullable).parquet(path)
    return rows if family is None else rows.where(F.col("topic") == family)


def source_freshness(landing: DataFrame, now) -> DataFrame:
    """Age of the newest arrival: warn after 2 hours, error after 6."""
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros("latest")) / F.lit(3.6e9)
    return (
        landing.agg(F.max("ingested_at").alias("latest"))
        .withColumn("age_hours", age)
        .withColumn(
            "status",
            F.when(F.col("age_hours") > 6, "error").when(F.col("age_hours") > 2, "warn")
            .when(F.col("latest").isNull(), "error").otherwise("pass"),
        )
    )
