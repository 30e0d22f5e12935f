"""Validation, ingestion, sinks, freshness, incremental and marketplace queries."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.bindings.landing_sql import landing_ctes
from kerbside.bindings.marts import Marts
from kerbside.bindings.queries import register
from kerbside.bindings.oracle import query
from kerbside.bindings.raw_sql import RAW_COLUMNS, raw_cte, raw_value
from kerbside.shared import shared_dir, written_once
from kerbside.sources import messages, sinks
from kerbside.streaming.ingest import IngestPaths, start_ingest
from kerbside.streaming.validation import (
    rejections_by_reason,
    reconcile_ingest,
    split,
    validate,
)

NOW = datetime(2002, 1, 1, 6, 30, tzinfo=UTC)
NOW_SQL = "TIMESTAMP '2002-01-01 06:30:00'"
# Compressed bytes of messages in a batch.
BATCH = str(512 << 20)


def _judged(final: str) -> str:
    return f"WITH {landing_ctes('duckdb')}{raw_cte()} {final}"


def raw_messages(m: Marts) -> DataFrame:
    """Both families as raw messages, stored once."""
    def build() -> DataFrame:
        landed = m.build_landing().unionByName(m.build_presence_landing())
        return landed.selectExpr(
            "cast(partition_key AS binary) AS key", f"cast({raw_value()} AS binary) AS value",
            *[c.strip() for c in RAW_COLUMNS.split(",")],
            "array(struct('event_type' AS key, cast(event_type AS binary) AS value)) AS headers",
        )

    return written_once(m.spark, m.sf_dir, "raw_messages", build)


register(
    "validate_messages",
    _judged("SELECT kafka_topic AS topic, kafka_partition AS partition, kafka_offset AS offset, "
            "reason FROM judged"),
)(lambda m: validate(raw_messages(m)).select("topic", "partition", "offset", "reason"))
register(
    "rejections_by_reason",
    _judged("SELECT reason, count(*) AS rejections FROM judged WHERE reason IS NOT NULL GROUP BY 1"),
)(lambda m: rejections_by_reason(split(validate(raw_messages(m)))[1]))
_RECONCILED = (
    "SELECT count(*) AS polled, count(DISTINCT id) AS landed, count(reason) AS rejected, "
    "count(id) - count(DISTINCT id) AS duplicates_dropped, true AS reconciles "
    "FROM (SELECT reason, json_extract_string(CASE WHEN reason IS NULL THEN v END, '$.event_id') "
    "AS id FROM judged)")
register("reconcile_ingest", _judged(_RECONCILED))(
    lambda m: reconcile_ingest(validate(raw_messages(m)))
)
register(
    "dead_letters",
    _judged("SELECT CASE kafka_topic WHEN 'trips.events.v1' THEN 'trips.events.dlq.v1' ELSE "
            "'drivers.presence.dlq.v1' END AS topic, reason AS rejection_reason, kafka_partition "
            "AS source_partition, kafka_offset AS source_offset, to_base64(encode(v)) "
            "AS original_value_base64 FROM judged WHERE reason IS NOT NULL"),
)(lambda m: sinks.dead_letter_rows(
    split(validate(raw_messages(m)))[1], "trip-ingestor", NOW
).select("topic", F.from_json(
    F.col("value").cast("string"),
    "rejection_reason string, source_partition int, source_offset bigint, "
    "original_value_base64 string",
).alias("b")).select(
    "topic", "b.rejection_reason", "b.source_partition", "b.source_offset",
    "b.original_value_base64",
))
register(
    "replay_dead_letters",
    _judged("SELECT kafka_topic AS topic, kafka_partition AS partition, kafka_offset AS offset, "
            "reason FROM judged WHERE reason IS NOT NULL"),
)(lambda m: validate(sinks.replay_dead_letters(
    sinks.dead_letter_rows(split(validate(raw_messages(m)))[1], "trip-ingestor", NOW)
)).select("topic", "partition", "offset", "reason"))


def ingested(m: Marts, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Landing, dead letters and report of a bounded streaming run over the raw messages."""
    raw = raw_messages(m)
    source = raw.inputFiles()[0].rsplit("/", 1)[0]
    # The data spans years, so this run keeps one directory per family instead of per hour.
    run = f"{shared_dir(m.spark)}/kerbside/stream-{name}-{uuid.uuid4().hex[:8]}"
    paths = IngestPaths(f"{run}/landing", f"{run}/dlq", f"{run}/checkpoint", f"{run}/report",
                        layout=("topic",))
    # A bounded run takes all there is, in batches of about one size however large the files are.
    stream = m.spark.readStream.schema(raw.schema).option("maxBytesPerTrigger", BATCH).parquet(source)
    start_ingest(stream, paths, {"availableNow": True}, clock=lambda: NOW).awaitTermination()
    return (messages.read_landing(m.spark, paths.landing), m.spark.read.parquet(paths.dead_letters),
            m.spark.read.parquet(paths.report))


register(
    "ingest_stream",
    _judged("SELECT CASE kafka_topic WHEN 'trips.events.v1' THEN 'trips' ELSE 'presence' END AS "
            "topic, json_extract_string(g, '$.event_type') AS event_type, "
            "count(DISTINCT json_extract_string(g, '$.event_id')) AS events "
            "FROM (SELECT *, CASE WHEN reason IS NULL THEN v END AS g FROM judged) "
            "WHERE reason IS NULL GROUP BY ALL"),
)(lambda m: ingested(m, "landing")[0].dropDuplicates(["event_id"]).groupBy("topic", "event_type")
  .agg(F.count(F.lit(1)).alias("events")))

register(
    "source_freshness",
    query("SELECT max(ingested_at) AS latest, date_diff('second', max(ingested_at), "
          f"{NOW_SQL}) / 3600.0 AS age_hours, CASE WHEN date_diff('second', max(ingested_at), "
          f"{NOW_SQL}) > 21600 THEN 'error' WHEN date_diff('second', max(ingested_at), {NOW_SQL}) "
          "> 7200 THEN 'warn' ELSE 'pass' END AS status FROM trip_landing"),
)(lambda m: messages.source_freshness(m.landing, NOW))
register(
    "freshness_marker",
    query(f"SELECT {NOW_SQL} AS exported_at, max(requested_at) AS latest_trip_at, "
          f"min(requested_at) AS earliest_trip_at, round(date_diff('second', max(requested_at), "
          f"{NOW_SQL}) / 3600.0, 2) AS data_age_hours, CASE WHEN date_diff('second', "
          f"max(requested_at), {NOW_SQL}) < -1800 THEN 'FUTURE_DATED' WHEN date_diff('second', "
          f"max(requested_at), {NOW_SQL}) <= 7200 THEN 'FRESH' WHEN date_diff('second', "
          f"max(requested_at), {NOW_SQL}) <= 21600 THEN 'STALE' ELSE 'VERY_STALE' END AS "
          "freshness_status, count(*) AS trip_rows FROM ft WHERE requested_at IS NOT NULL", "ft"),
)(lambda m: sinks.freshness_marker(m.fct_trips, NOW))
register(
    "run_report",
    query("SELECT (SELECT count(*) FROM trip_landing) AS landed_rows, (SELECT count(DISTINCT "
          "event_id) FROM trip_landing) AS distinct_events, (SELECT count(*) - count(DISTINCT "
          "event_id) FROM trip_landing) AS duplicates_removed, (SELECT count(*) FROM base) AS "
          "staged_rows, (SELECT count(*) FROM ft) AS trips, (SELECT count(*) FROM ft WHERE "
          "is_quarantined) AS quarantined_trips", "base", "ft"),
)(lambda m: sinks.run_report(m.once("landing"), m.base, m.once("fct_trips", "trips")))
register(
    "routed_messages",
    query("SELECT kafka_topic AS topic, event_id, event_type AS header_type, correlation_id, "
          "length(payload_json) > 2 AS has_payload FROM base UNION ALL SELECT kafka_topic, event_id, "
          "event_type, correlation_id, length(payload_json) > 2 FROM pbase", "base", "pbase"),
)(lambda m: sinks.route_to_topics(m.base.unionByName(m.presence)).select(
    "topic", F.get_json_object(F.col("value").cast("string"), "$.event_id").alias("event_id"),
    F.col("headers")[0]["value"].cast("string").alias("header_type"),
    F.get_json_object(F.col("value").cast("string"), "$.correlation_id").alias("correlation_id"),
    (F.length(F.get_json_object(F.col("value").cast("string"), "$.payload")) > 2).alias(
        "has_payload"),
))


def exported(m: Marts) -> DataFrame:
    path = f"{shared_dir(m.spark)}/kerbside/export-{uuid.uuid4().hex[:8]}"
    return sinks.export_marts(
        {**m.dims, "dim_time": m.dim_time, "dim_date": m.dim_date, "fct_trips": m.fct_trips,
         "fct_payments": m.fct_payments, "fct_driver_sessions": m.fct_driver_sessions,
         "fct_trip_events": m.once("fct_trip_events"), "quarantined_trips": m.quarantined_trips,
         "fct_pipeline_quality": m.fct_pipeline_quality}, path,
    )


_COUNTS = {"dim_time": "dt", "dim_date": "dd", "fct_trips": "ft", "fct_payments": "fp",
           "fct_driver_sessions": "fs", "fct_trip_events": "fe", "fct_pipeline_quality": "quality"}
_DIMS = ("dim_city", "dim_zone", "dim_vehicle_type", "dim_customer_tier", "dim_payment_method",
         "dim_payment_status", "dim_ride_status", "dim_cancellation_reason", "dim_driver_status",
         "dim_weather", "dim_traffic_level")
register(
    "export_marts",
    query(" UNION ALL ".join(
        [f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {c}" for n, c in _COUNTS.items()]
        + [f"SELECT '{n}', count(*) FROM {n}" for n in _DIMS]
        + ["SELECT 'quarantined_trips', count(*) FROM ft WHERE is_quarantined"]),
        *_COUNTS.values(), *_DIMS),
)(exported)


def jsonl_round_trip(m: Marts) -> DataFrame:
    """JSON lines by arrival hour, written and read back."""
    path = f"{shared_dir(m.spark)}/kerbside/jsonl-{uuid.uuid4().hex[:8]}"
    out = sinks.route_to_topics(m.presence)
    arrival = F.get_json_object(F.col("value").cast("string"), "$.ingested_at").cast("timestamp")
    # Arrival by month keeps the number of directories small on this data.
    sinks.write_jsonl(out, path, F.date_trunc("month", arrival))
    return validate(messages.read_events_jsonl(m.spark, path)).select("event_id", "event_type",
                                                                      "topic", "reason")


_EXTRA = "json_extract_string(payload_json, '$.driver_status')"
register(
    "jsonl_round_trip",
    query(f"SELECT event_id, event_type, kafka_topic AS topic, CASE WHEN {_EXTRA} = 'NAPPING' THEN "
          "'SCHEMA_VIOLATION' END AS reason FROM pbase", "pbase"),
)(jsonl_round_trip)
