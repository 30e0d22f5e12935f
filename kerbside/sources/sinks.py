"""Writers: landing zone, dead letters, topics, JSON lines, mart export, run reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import round_dp
from kerbside.operators.dedup import duplicate_stats
from kerbside.schemas import DLQ_FOR, LANDING, PRESENCE_EVENT_TYPES, TOPIC_PRESENCE, TOPIC_TRIPS

FUTURE_TOLERANCE_HOURS = 0.5


def write_landing(
    valid: DataFrame, path: str, landed_at, layout: tuple[str, ...] = ("topic", "dt", "hour")
) -> None:
    """Append valid events, one load time for the whole batch, by family, date and hour.

    Rows rebalance by directory: small directories get one file, and adaptive execution
    splits a large one over several tasks and files.
    """
    rows = valid.withColumn("landed_at", F.lit(landed_at).cast("timestamp"))
    (
        rows.select(*LANDING.names)
        .hint("rebalance", *layout)
        .write.partitionBy(*layout).mode("append").parquet(path)
    )


def _readable(value: Column) -> Column:
    """Bytes as text; bytes that are no text are replaced, not dropped."""
    return F.make_valid_utf8(value.cast("string"))


def dead_letter_rows(rejected: DataFrame, group: str, now=None) -> DataFrame:
    """Rejected messages as (topic, key, value) with their evidence kept byte for byte."""
    rejected_at = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    headers = F.coalesce(F.col("headers"), F.array().cast(rejected.schema["headers"].dataType))
    # The last header of a name wins.
    named = F.map_from_entries(
        F.filter(
            F.transform(
                headers, lambda h: F.struct(h["key"].alias("key"), _readable(h["value"]).alias("value"))
            ),
            lambda h: h["key"].isNotNull(),
        )
    )
    body = F.struct(
        F.col("reason").alias("rejection_reason"),
        F.col("detail").alias("rejection_detail"),
        F.date_format(rejected_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("rejected_at"),
        F.lit(group).alias("consumer_group"),
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        _readable(F.col("key")).alias("original_key"),
        # The encoder wraps long text; consumers of the topic expect one line.
        F.regexp_replace(F.base64("value"), r"\s", "").alias("original_value_base64"),
        named.alias("original_headers"),
    )
    target = reduce(
        lambda rest, pair: F.when(F.col("topic") == pair[0], pair[1]).otherwise(rest),
        DLQ_FOR.items(), F.lit(None).cast("string"),
    )
    return rejected.select(
        target.alias("topic"), "key",
        F.to_json(body, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
    )


def replay_dead_letters(letters: DataFrame) -> DataFrame:
    """Dead letters back in raw message shape, ready to be validated again."""
    body = F.from_json(
        F.col("value").cast("string"),
        "source_topic string, source_partition int, source_offset bigint, original_key string, "
        "original_value_base64 string, original_headers map<string,string>",
    )
    headers = F.transform(
        F.map_entries("b.original_headers"),
        lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")),
    )
    return letters.select(body.alias("b")).select(
        F.col("b.original_key").cast("binary").alias("key"),
        F.unbase64("b.original_value_base64").alias("value"),
        F.col("b.source_topic").alias("topic"),
        F.col("b.source_partition").alias("partition"),
        F.col("b.source_offset").alias("offset"),
        headers.alias("headers"),
    )


def route_to_topics(events: DataFrame) -> DataFrame:
    """Landing-shaped events as keyed messages with routing headers."""
    envelope = [c for c in LANDING.names[:11]]
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    fields = [
        F.date_format(c, stamp).alias(c) if c in ("event_timestamp", "ingested_at") else F.col(c)
        for c in envelope
    ]
    head = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    # The payload is JSON already; it is spliced in, not encoded a second time.
    body = F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"payload":'),
        F.col("payload_json"), F.lit("}"),
    )
    header = [
        ("event_type", F.col("event_type")), ("event_version", F.col("event_version")),
        ("content_type", F.lit("application/json")),
        ("producer_service", F.col("producer_service")),
    ]
    return events.select(
        F.when(F.col("event_type").isin(*PRESENCE_EVENT_TYPES), TOPIC_PRESENCE)
        .otherwise(TOPIC_TRIPS).alias("topic"),
        F.col("partition_key").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.array(
            *[F.struct(F.lit(n).alias("key"), v.cast("binary").alias("value")) for n, v in header]
        ).alias("headers"),
    )


def write_jsonl(messages: DataFrame, path: str, arrival: Column | None = None) -> None:
    """Messages as JSON lines, by arrival date and hour when an arrival time is given."""
    line = F.col("value").cast("string").alias("value")
    if arrival is None:
        messages.select(line).write.mode("append").text(path)
        return
    (
        messages.select(line, F.to_date(arrival).alias("dt"), F.hour(arrival).alias("hour"))
        .hint("rebalance", "dt", "hour")
        .write.partitionBy("dt", "hour").mode("append").text(path)
    )


def export_marts(marts: dict[str, DataFrame], path: str) -> DataFrame:
    """Write every mart as flat snappy Parquet; (table, rows) read back from the files."""
    spark = next(iter(marts.values())).sparkSession
    counts = []
    for name, mart in marts.items():
        nested = [f.name for f in mart.schema if f.dataType.typeName() in ("struct", "array", "map")]
        if nested:
            raise ValueError(f"{name} has nested columns: {nested}")
        target = f"{path.rstrip('/')}/{name}.parquet"
        mart.write.mode("overwrite").option("compression", "snappy").parquet(target)
        counts.append(
            spark.read.parquet(target).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"), "rows")
        )
    return reduce(DataFrame.unionByName, counts)


def freshness_status(age_hours: Column) -> Column:
    return (
        F.when(age_hours.isNull(), "UNKNOWN")
        .when(age_hours < -FUTURE_TOLERANCE_HOURS, "FUTURE_DATED")
        .when(age_hours <= 2, "FRESH")
        .when(age_hours <= 6, "STALE")
        .otherwise("VERY_STALE")
    )


def freshness_marker(trips: DataFrame, now) -> DataFrame:
    """Age of the newest trip in the data, not of the export."""
    at = F.lit(now).cast("timestamp")
    age = (F.unix_micros(at) - F.unix_micros("latest_trip_at")) / F.lit(3.6e9)
    return (
        trips.where(F.col("requested_at").isNotNull())
        .agg(F.max("requested_at").alias("latest_trip_at"),
             F.min("requested_at").alias("earliest_trip_at"),
             F.count(F.lit(1)).alias("trip_rows"))
        .select(
            at.alias("exported_at"), "latest_trip_at", "earliest_trip_at",
            round_dp(age, 2).alias("data_age_hours"),
            freshness_status(age).alias("freshness_status"), "trip_rows",
        )
    )


def run_report(landing: DataFrame, staged: DataFrame, trips: DataFrame) -> DataFrame:
    """One row: landed, distinct, duplicates removed, staged, trips, quarantined."""
    stats = duplicate_stats(landing).select(
        F.col("rows").alias("landed_rows"), F.col("distinct_ids").alias("distinct_events"),
        F.col("duplicates").alias("duplicates_removed"),
    )

    # Both counts from one pass.
    counted = trips.agg(F.count(F.lit(1)).alias("trips"),
                        F.count_if("is_quarantined").alias("quarantined_trips"))
    return stats.crossJoin(staged.agg(F.count(F.lit(1)).alias("staged_rows"))).crossJoin(counted)
