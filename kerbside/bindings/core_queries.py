"""Staging, assembly, fact and dimension queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.bindings.oracle import columns, query
from kerbside.bindings.queries import register
from kerbside.operators import assembly, dedup
from kerbside.plans import quality
from kerbside.plans.facts import _TRIP_COLUMNS
from kerbside.schemas import EVENT_FIELDS
from kerbside.shared import written_once

# ---- FIXED VALUES: column lists below are the output columns of their tables ------
_BASE = (
    "event_id", "event_type", "event_timestamp", "ingested_at", "partition_key",
    "correlation_id", "causation_id", "environment", "payload_json", "kafka_topic",
    "kafka_partition", "kafka_offset", "lateness_sec", "is_late_arrival_event", "landed_at",
    "landed_date", "landed_hour",
)

# ---- deduplicated base and typed events -----------------------------------------

register("base_trip_events", query(f"SELECT {columns(_BASE)} FROM base", "base"))(
    lambda m: m.build_base().select(*_BASE)
)
register("base_presence_events", query(f"SELECT {columns(_BASE)} FROM pbase", "pbase"))(
    lambda m: m.build_presence().select(*_BASE)
)

_TYPED = {
    "ride_requested": ("req", "RideRequested", ""),
    "ride_accepted": ("acc", "RideAccepted", ""),
    "driver_arrived": ("arr", "DriverArrived", ""),
    "ride_started": ("sta", "RideStarted", ""),
    "ride_completed": (
        "com", "RideCompleted",
        ", cast(base_fare + distance_fare + time_fare + surge_amount + airport_fee + toll_amount"
        " + booking_fee + tax_amount AS double) AS fare_component_sum,"
        " cast(driver_payout + platform_commission AS double) AS payout_split_sum,"
        " cast(total_fare - tax_amount AS double) AS pre_tax_subtotal",
    ),
    "ride_cancelled": ("can", "RideCancelled", ""),
    "payment_completed": (
        "pay", "PaymentCompleted",
        ", attempt_number > 1 AS had_failed_attempts,"
        " cast(trip_fare + tip_amount - discount_amount AS double) AS expected_amount_charged",
    ),
    "driver_online": ("onl", "DriverOnline", ""),
    "driver_offline": ("off", "DriverOffline", ""),
}


def _typed_query(event_type: str):
    return lambda m: m.typed(event_type).drop("lateness_sec", "landed_at")


for _name, (_cte, _type, _more) in _TYPED.items():
    _fields = [field for field, _ in EVENT_FIELDS[_type]]
    _select = columns(["event_id", "event_timestamp", "ingested_at", *_fields])
    register(f"typed_{_name}", query(f"SELECT {_select}{_more} FROM {_cte}", _cte))(
        _typed_query(_type)
    )

register(
    "duplicate_stats",
    query("SELECT count(*) AS rows, count(DISTINCT event_id) AS distinct_ids, "
          "count(*) - count(DISTINCT event_id) AS duplicates FROM trip_landing"),
)(lambda m: dedup.duplicate_stats(m.landing))

register(
    "dedup_batch_by_message_order",
    query("SELECT event_id, kafka_partition, kafka_offset FROM (SELECT *, row_number() OVER "
          "(PARTITION BY event_id ORDER BY kafka_topic, kafka_partition, kafka_offset) AS r "
          "FROM presence_landing) WHERE r = 1"),
)(lambda m: dedup.dedup_batch(m.presence_landing).select("event_id", "kafka_partition",
                                                         "kafka_offset"))

# ---- assembly -------------------------------------------------------------------

_STATS = (
    "trip_id", "event_count", "max_lateness_sec", "had_late_events", "first_ingested_at",
    "last_ingested_at",
)
register("event_stats", query(f"SELECT {columns(_STATS)} FROM stats", "stats"))(
    lambda m: assembly.event_stats(m.base)
)

_ASSEMBLED = (
    "trip_id", "rider_id", "driver_id", "city_id", "requested_at", "accepted_at", "arrived_at",
    "started_at", "completed_at", "cancelled_at", "paid_at", "is_expired",
    "funnel_stage_reached", "ride_status_code", "total_lifecycle_sec", "estimate_accuracy_pct",
    "distance_accuracy_pct", "eta_accuracy_pct", "revenue_per_km", "is_sequence_valid",
    "event_count", "max_lateness_sec", "had_late_events", "latest_request",
)
register("trips_assembled", query(f"SELECT {columns(_ASSEMBLED)} FROM trips", "trips"))(
    lambda m: m.build_trips().select(*_ASSEMBLED)
)

_SESSION = (
    "session_id", "driver_id", "city_id", "vehicle_id", "vehicle_type", "driver_status",
    "online_at", "offline_at", "online_zone_id", "offline_zone_id", "session_duration_sec",
    "reported_trips_completed", "dispatched_trips", "observed_trips_completed",
    "revenue_in_session", "payout_in_session", "on_trip_seconds", "is_session_open",
    "trips_per_online_hour", "utilisation_pct", "zone_drift",
)
register("sessions_assembled", query(f"SELECT {columns(_SESSION)} FROM ses", "ses"))(
    lambda m: m.build_sessions().select(*_SESSION)
)

# ---- facts and dimensions -------------------------------------------------------

register("fct_trips", query(f"SELECT {columns(_TRIP_COLUMNS)} FROM ft", "ft"))(
    lambda m: m.build_fct_trips()
)

_PAYMENT = (
    "payment_id", "trip_id", "rider_id", "driver_id", "city_id", "payment_method_id",
    "payment_status_id", "paid_date_id", "paid_time_id", "paid_at", "trip_fare", "tip_amount",
    "discount_amount", "amount_charged", "currency", "promo_code", "attempt_number",
    "previous_attempt_failure_reason", "gateway_reference", "had_failed_attempts",
    "settlement_due_at", "gateway_fee_amount", "is_quarantined",
)
register("fct_payments", query(f"SELECT {columns(_PAYMENT)} FROM fp", "fp"))(
    lambda m: m.build_fct_payments().select(*_PAYMENT)
)

_DRIVER_SESSION = (
    "session_id", "driver_id", "vehicle_id", "city_id", "vehicle_type_id", "driver_status_id",
    "online_zone_id", "offline_zone_id", "online_date_id", "online_time_id", "online_at",
    "offline_at", "online_lat", "online_lon", "offline_lat", "offline_lon", "offline_reason",
    "session_duration_sec", "reported_trips_completed", "dispatched_trips",
    "observed_trips_completed", "revenue_in_session", "payout_in_session", "on_trip_seconds",
    "trips_per_online_hour", "utilisation_pct", "zone_drift", "is_session_open",
    "counts_disagree", "device_platform", "app_version",
)
register("fct_driver_sessions", query(f"SELECT {columns(_DRIVER_SESSION)} FROM fs", "fs"))(
    lambda m: m.build_fct_driver_sessions()
)

_TRIP_EVENT = (
    "event_id", "event_type", "event_version", "trip_id", "partition_key", "causation_id",
    "city_id", "event_timestamp", "ingested_at", "event_date_id", "event_time_id",
    "event_sequence_number", "is_out_of_order", "lateness_sec", "is_late_arrival_event",
    "is_duplicate", "producer_service", "producer_version", "environment", "payload_json",
    "kafka_topic", "kafka_partition", "kafka_offset",
)
register("fct_trip_events", query(f"SELECT {columns(_TRIP_EVENT)} FROM fe", "fe"))(
    lambda m: m.build_fct_trip_events()
)

_DATE = (
    "date_id", "full_date", "day_of_week", "day_name", "is_weekend", "week_of_year",
    "day_of_month", "month_number", "month_name", "quarter", "year", "is_holiday",
    "holiday_name",
)
register("dim_date", query(f"SELECT {columns(_DATE)} FROM dd", "dd"))(lambda m: m.dim_date)

# The time dimension read through the trips that use it.
register(
    "dim_time_in_use",
    query("SELECT time_id, hour_24, minute, time_of_day, day_part, is_peak_hour, "
          "count(*) AS requests FROM ft JOIN dt ON ft.request_time_id = dt.time_id "
          "GROUP BY ALL", "ft", "dt"),
)(
    lambda m: m.once("fct_trips", "trips").join(m.dim_time, F.col("request_time_id") == F.col("time_id"))
    .groupBy("time_id", "hour_24", "minute", "time_of_day", "day_part", "is_peak_hour")
    .agg(F.count(F.lit(1)).alias("requests"))
)

register(
    "quarantined_trips",
    query("SELECT trip_id, ride_status_id, requested_at, cast(total_fare AS double) AS total_fare, "
          "NOT has_request_event AS missing_request_event, "
          "NOT is_sequence_valid AS invalid_sequence, "
          "CASE WHEN NOT has_request_event "
          "THEN 'no request event landed, so the trip has no request attributes' "
          "ELSE 'the order of lifecycle events is contradictory' END AS quarantine_reason, "
          "event_count, cast(max_lateness_sec AS double) AS max_lateness_sec "
          "FROM ft WHERE is_quarantined", "ft"),
)(lambda m: m.quarantined_trips)

_QUALITY = (
    "landed_date", "trip_events_landed", "presence_events_landed", "trips", "payments",
    "driver_sessions", "duplicate_events_remaining", "late_arrivals", "clock_skewed_events",
    "max_lateness_sec", "median_lateness_sec", "orphaned_trips", "sequence_invalid_trips",
    "inferred_expired_trips", "payments_without_completion", "unexplained_revenue",
    "unknown_city_keys", "unknown_vehicle_keys", "unknown_tier_keys", "unknown_status_keys",
    "open_sessions", "sessions_counts_disagree", "orphaned_trip_pct", "sequence_invalid_pct",
    "late_arrival_pct",
)
register("fct_pipeline_quality", query(f"SELECT {columns(_QUALITY)} FROM quality", "quality"))(
    lambda m: m.fct_pipeline_quality
)


def quality_from_increments(m: Marts):
    """The quality table from the states of two halves, one of them first loaded and replaced."""
    def half(n: int):
        def mine(df, key):
            return df.where(F.pmod(F.xxhash64(key), F.lit(2)) == n)

        return quality.quality_states(
            mine(m.base, "correlation_id"), mine(m.presence, "correlation_id"),
            mine(m.fct_trips, "trip_id"), mine(m.fct_payments, "trip_id"),
            mine(m.fct_driver_sessions, "session_id"))

    # Kept as small as a run keeps it.
    first = written_once(m.spark, m.sf_dir, "quality_of_half",
                         lambda: quality.merged_states(half(0)))
    return quality.quality_from_states(
        quality.merged_states(first, half(0), half(1), removed=[first]))


register("quality_from_increments", query(f"SELECT {columns(_QUALITY)} FROM quality", "quality"))(
    quality_from_increments
)
