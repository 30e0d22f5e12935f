"""Landing rows to a deduplicated base, and the base to one typed table per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.scalars import payload_sql
from kerbside.operators.dedup import dedup_keep_first, mark_repeated
from kerbside.schemas import LATE_MILLIS, event_fields, text_schema

BASE_COLUMNS = (
    "event_id", "event_type", "event_version", "event_timestamp", "ingested_at",
    "partition_key", "correlation_id", "causation_id", "producer_service", "producer_version",
    "environment", "payload_json", "kafka_topic", "kafka_partition", "kafka_offset",
)


def in_environment(landing: DataFrame, environment: str) -> DataFrame:
    """Only one environment's events; filtered before deduplication."""
    return landing.where(F.col("environment") == environment)


def lateness_millis() -> Column:
    return F.unix_millis("ingested_at") - F.unix_millis("event_timestamp")


def base_columns(landing: DataFrame) -> DataFrame:
    """Landing rows, copies included, with signed lateness and the load clock filled in."""
    landed_at = (
        F.coalesce(F.col("landed_at"), F.col("ingested_at"))
        if "landed_at" in landing.columns
        else F.col("ingested_at")
    )
    # Landing partitions come from the arrival clock, so both are recomputed when absent.
    dt = F.col("dt") if "dt" in landing.columns else F.to_date("ingested_at")
    hour = F.col("hour") if "hour" in landing.columns else F.hour("ingested_at")
    return landing.select(
        *BASE_COLUMNS,
        (lateness_millis() / F.lit(1000.0)).alias("lateness_sec"),
        (lateness_millis() > LATE_MILLIS).alias("is_late_arrival_event"),
        landed_at.alias("landed_at"),
        dt.alias("landed_date"),
        hour.alias("landed_hour"),
    )


def base_events(landing: DataFrame, environment: str = "local") -> DataFrame:
    """One row per event id, the first to arrive."""
    return base_columns(dedup_keep_first(in_environment(landing, environment)))


def marked_events(landing: DataFrame, environment: str = "local") -> DataFrame:
    """What `base_events` chooses from, with a flag on rows that may have copies."""
    return mark_repeated(base_columns(in_environment(landing, environment)))


def parsed_payload(df: DataFrame, fields: list[str], name: str = "_payload") -> DataFrame:
    """Parse the payload once per row into a struct of text fields."""
    return df.withColumn(name, F.from_json("payload_json", text_schema(fields)))


_DERIVED = {
    "RideCompleted": {
        "fare_component_sum": (
            "base_fare + distance_fare + time_fare + surge_amount + airport_fee + toll_amount "
            "+ booking_fee + tax_amount"
        ),
        "payout_split_sum": "driver_payout + platform_commission",
        "pre_tax_subtotal": "total_fare - tax_amount",
    },
    "PaymentCompleted": {
        "had_failed_attempts": "attempt_number > 1",
        "expected_amount_charged": "trip_fare + tip_amount - discount_amount",
    },
}
_EXTRA_ENVELOPE = {"RideRequested": ("lateness_sec",), "PaymentCompleted": ("landed_at",)}


def typed_events(base: DataFrame, event_type: str) -> DataFrame:
    """The events of one type with their payload as typed columns."""
    fields = event_fields(event_type)
    envelope = ("event_id", "event_timestamp", "ingested_at", *_EXTRA_ENVELOPE.get(event_type, ()))
    parsed = parsed_payload(base.where(F.col("event_type") == event_type), [f for f, _ in fields])
    typed = parsed.selectExpr(
        *envelope, *[f"{payload_sql(f, kind, '_payload')} AS {f}" for f, kind in fields]
    )
    derived = _DERIVED.get(event_type)
    if not derived:
        return typed
    return typed.selectExpr("*", *[f"{sql} AS {name}" for name, sql in derived.items()])
