"""Fact tables of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import (
    local_date_key,
    local_hour,
    local_time_key,
    payload_int,
    round_dp,
    unknown_key,
)
from kerbside.operators.joins import lookup_key, lookup_keys
from kerbside.operators.sequence import sequence_events
from kerbside.operators.staging import typed_events
from kerbside.sources.dimensions import city_zones

Dims = dict[str, DataFrame]

# alias: (fact column, dimension, code column, id column). One dimension, several roles.
_TRIP_ROLES = {
    "vehicle_type_id": ("delivered_vehicle_type", "dim_vehicle_type", "vehicle_type_code",
                        "vehicle_type_id"),
    "requested_vehicle_type_id": ("requested_vehicle_type", "dim_vehicle_type",
                                  "vehicle_type_code", "vehicle_type_id"),
    "customer_tier_id": ("customer_tier", "dim_customer_tier", "customer_tier_code",
                         "customer_tier_id"),
    "ride_status_id": ("ride_status_code", "dim_ride_status", "ride_status_code",
                       "ride_status_id"),
    "cancelled_at_status_id": ("cancelled_at_status", "dim_ride_status", "ride_status_code",
                               "ride_status_id"),
    "cancellation_reason_id": ("cancellation_reason_code", "dim_cancellation_reason",
                               "cancellation_reason_code", "cancellation_reason_id"),
    "request_weather_id": ("request_weather_code", "dim_weather", "weather_code", "weather_id"),
    "trip_weather_id": ("trip_weather_code", "dim_weather", "weather_code", "weather_id"),
    "request_traffic_level_id": ("request_traffic_level", "dim_traffic_level",
                                 "traffic_level_code", "traffic_level_id"),
    "trip_traffic_level_id": ("trip_traffic_level", "dim_traffic_level", "traffic_level_code",
                              "traffic_level_id"),
}

# ---- FIXED VALUES -------------------------------------------------------------
# Columns of the trip fact, in order.
_TRIP_COLUMNS = (
    # identity and surrogate keys
    "trip_id", "rider_id", "driver_id", "vehicle_id", "city_id", "vehicle_type_id",
    "requested_vehicle_type_id", "customer_tier_id", "ride_status_id", "cancelled_at_status_id",
    "cancellation_reason_id", "pickup_zone_id", "dropoff_zone_id", "actual_dropoff_zone_id",
    "driver_pickup_zone_id", "request_weather_id", "trip_weather_id",
    "request_traffic_level_id", "trip_traffic_level_id", "request_date_id", "request_time_id",
    "request_local_hour",
    # stage times
    "requested_at", "accepted_at", "arrived_at", "started_at", "completed_at", "cancelled_at",
    "paid_at",
    # request
    "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "estimated_fare",
    "estimated_distance_km", "estimated_duration_sec", "surge_multiplier", "is_airport_pickup",
    "is_airport_dropoff", "promo_code", "device_platform", "app_version",
    # match, pickup, ride
    "matching_duration_sec", "eta_to_pickup_sec", "distance_to_pickup_km",
    "driver_rating_at_accept", "dispatch_attempt_number", "actual_pickup_duration_sec",
    "arrival_delay_sec", "is_late_arrival", "rider_wait_duration_sec", "actual_pickup_lat",
    "actual_pickup_lon", "distance_km", "duration_sec",
    # money
    "base_fare", "distance_fare", "time_fare", "surge_amount", "airport_fee", "toll_amount",
    "booking_fee", "tax_amount", "total_fare", "driver_payout", "platform_commission",
    "currency",
    # cancellation and payment
    "cancelled_by", "seconds_since_request", "cancellation_fee", "is_fee_charged",
    "is_driver_fault", "payment_id", "payment_attempt_number", "had_failed_attempts",
    # derived
    "is_completed", "is_cancelled", "is_paid", "is_matched", "is_surge_trip",
    "funnel_stage_reached", "total_lifecycle_sec", "estimate_accuracy_pct",
    "distance_accuracy_pct", "eta_accuracy_pct", "revenue_per_km", "is_inferred_expired",
    "event_count", "max_lateness_sec", "had_late_events", "is_sequence_valid",
    "has_request_event", "is_quarantined",
)
# ---- end of fixed values ------------------------------------------------------

_ZONE_ROLES = ("pickup_zone_id", "dropoff_zone_id", "actual_dropoff_zone_id",
               "driver_pickup_zone_id")


def _with_local_zone(df: DataFrame, dims: Dims, city: str = "city_id") -> DataFrame:
    zones = city_zones(dims).withColumnRenamed("city_id", "_city")
    return df.join(zones, F.col(city) == F.col("_city"), "left").drop("_city")


def fct_trips(trips: DataFrame, dims: Dims) -> DataFrame:
    """One row per trip, completed or not, with surrogate keys and local request time."""
    fact = _with_local_zone(trips, dims)
    zone = F.col("city_timezone")
    requested = F.col("requested_at")
    fact = fact.withColumns(
        {
            "city_id": unknown_key(F.col("city_id")),
            **{z: unknown_key(F.col(z)) for z in _ZONE_ROLES},
            "request_date_id": local_date_key(requested, zone),
            "request_time_id": local_time_key(requested, zone),
            "request_local_hour": local_hour(requested, zone),
            "is_inferred_expired": F.col("is_expired"),
        }
    )
    return lookup_keys(
        fact,
        {alias: (code, dims[dim], dim_code, dim_id)
         for alias, (code, dim, dim_code, dim_id) in _TRIP_ROLES.items()},
        _TRIP_COLUMNS,
    ).select(*_TRIP_COLUMNS)


def fct_payments(
    base: DataFrame, dims: Dims, trips: DataFrame | None = None
) -> DataFrame:
    """One row per payment with settlement date and gateway fee.

    With the trip fact given, `is_quarantined` of the trip is carried onto the payment, so
    money measures can leave out the same trips on both sides.
    """
    payments = typed_events(base, "PaymentCompleted")
    methods = dims["dim_payment_method"].select(
        F.col("payment_method_code").alias("_method"),
        "payment_method_id",
        "settlement_delay_hours",
        "gateway_fee_pct",
    )
    fact = _with_local_zone(payments, dims).join(
        methods, F.col("payment_method") == F.col("_method"), "left"
    )
    fact = lookup_key(fact, dims["dim_payment_status"], "payment_status", "payment_status_code",
                      "payment_status_id", "payment_status_id")
    zone = F.col("city_timezone")
    paid = F.col("paid_at")
    charge = (F.col("amount_charged") * F.col("gateway_fee_pct")).cast("double")
    fee = round_dp(charge / F.lit(100.0), 2)
    out = fact.select(
        "payment_id", "trip_id", "rider_id", "driver_id",
        unknown_key(F.col("city_id")).alias("city_id"),
        unknown_key(F.col("payment_method_id")).alias("payment_method_id"),
        "payment_status_id",
        local_date_key(paid, zone).alias("paid_date_id"),
        local_time_key(paid, zone).alias("paid_time_id"),
        "paid_at", "trip_fare", "tip_amount", "discount_amount", "amount_charged", "currency",
        "promo_code", "attempt_number", "previous_attempt_failure_reason", "gateway_reference",
        "had_failed_attempts",
        (paid + F.make_dt_interval(hours=F.col("settlement_delay_hours"))).alias(
            "settlement_due_at"
        ),
        fee.cast("decimal(12,2)").alias("gateway_fee_amount"),
    )
    if trips is None:
        return out
    return out.join(trips.select("trip_id", "is_quarantined"), "trip_id", "left")


def fct_driver_sessions(sessions: DataFrame, dims: Dims) -> DataFrame:
    """One row per driver session; reported and observed work compared."""
    fact = _with_local_zone(sessions, dims)
    fact = lookup_keys(fact, {
        "vehicle_type_id": ("vehicle_type", dims["dim_vehicle_type"], "vehicle_type_code",
                            "vehicle_type_id"),
        "driver_status_id": ("driver_status", dims["dim_driver_status"], "driver_status_code",
                             "driver_status_id"),
    })
    zone = F.col("city_timezone")
    online = F.col("online_at")
    return fact.select(
        "session_id", "driver_id", "vehicle_id",
        unknown_key(F.col("city_id")).alias("city_id"),
        "vehicle_type_id", "driver_status_id",
        unknown_key(F.col("online_zone_id")).alias("online_zone_id"),
        unknown_key(F.col("offline_zone_id")).alias("offline_zone_id"),
        local_date_key(online, zone).alias("online_date_id"),
        local_time_key(online, zone).alias("online_time_id"),
        "online_at", "offline_at", "online_lat", "online_lon", "offline_lat", "offline_lon",
        "offline_reason", "session_duration_sec", "reported_trips_completed",
        F.col("dispatched_trips").cast("bigint").alias("dispatched_trips"),
        F.col("observed_trips_completed").cast("bigint").alias("observed_trips_completed"),
        F.col("revenue_in_session").cast("decimal(18,2)").alias("revenue_in_session"),
        F.col("payout_in_session").cast("decimal(18,2)").alias("payout_in_session"),
        F.col("on_trip_seconds").cast("bigint").alias("on_trip_seconds"),
        "trips_per_online_hour", "utilisation_pct", "zone_drift", "is_session_open",
        (F.col("reported_trips_completed") != F.col("observed_trips_completed")).alias(
            "counts_disagree"
        ),
        "device_platform", "app_version",
    )


def fct_trip_events(
    base: DataFrame, dims: Dims, sizes_from: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Atomic audit record of every trip event with causal position and local time."""
    events = sequence_events(base, sizes_from, hot).withColumn("_event_city", payload_int("city_id"))
    fact = _with_local_zone(events, dims, "_event_city")
    zone = F.coalesce("city_timezone", F.lit("UTC"))
    at = F.col("event_timestamp")
    return fact.select(
        "event_id", "event_type", "event_version",
        F.col("correlation_id").alias("trip_id"),
        "partition_key", "causation_id",
        unknown_key(F.col("_event_city")).alias("city_id"),
        "event_timestamp", "ingested_at",
        local_date_key(at, zone).alias("event_date_id"),
        local_time_key(at, zone).alias("event_time_id"),
        "event_sequence_number", "is_out_of_order", "lateness_sec", "is_late_arrival_event",
        F.lit(False).alias("is_duplicate"),
        "producer_service", "producer_version", "environment", "payload_json", "kafka_topic",
        "kafka_partition", "kafka_offset",
    )
