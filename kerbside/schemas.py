"""Landing schema, event families and the typed field table of each event."""

from __future__ import annotations

from pyspark.sql import types as T

TRIPS = "trips"
PRESENCE = "presence"

TOPIC_TRIPS = "trips.events.v1"
TOPIC_PRESENCE = "drivers.presence.v1"
FAMILY_FOR = {TOPIC_TRIPS: TRIPS, TOPIC_PRESENCE: PRESENCE}
DLQ_FOR = {TOPIC_TRIPS: "trips.events.dlq.v1", TOPIC_PRESENCE: "drivers.presence.dlq.v1"}

LATE_MILLIS = 300_000

_ts = T.TimestampType()
_s = T.StringType()

LANDING = T.StructType(
    [
        T.StructField("event_id", _s, False),
        T.StructField("event_type", _s, False),
        T.StructField("event_version", _s, False),
        T.StructField("event_timestamp", _ts, False),
        T.StructField("ingested_at", _ts, False),
        T.StructField("partition_key", _s, False),
        T.StructField("correlation_id", _s, False),
        T.StructField("causation_id", _s, True),
        T.StructField("producer_service", _s, False),
        T.StructField("producer_version", _s, False),
        T.StructField("environment", _s, False),
        T.StructField("payload_json", _s, False),
        T.StructField("kafka_topic", _s, False),
        T.StructField("kafka_partition", T.IntegerType(), False),
        T.StructField("kafka_offset", T.LongType(), False),
        T.StructField("landed_at", _ts, True),
        T.StructField("topic", _s, True),
        T.StructField("dt", T.DateType(), True),
        T.StructField("hour", T.IntegerType(), True),
    ]
)

# The shape every validator input has, whatever the transport.
RAW_MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", _s),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField(
            "headers",
            T.ArrayType(
                T.StructType([T.StructField("key", _s), T.StructField("value", T.BinaryType())])
            ),
        ),
    ]
)

TRIP_EVENT_TYPES = (
    "RideRequested",
    "RideAccepted",
    "DriverArrived",
    "RideStarted",
    "RideCompleted",
    "RideCancelled",
    "PaymentCompleted",
)
PRESENCE_EVENT_TYPES = ("DriverOnline", "DriverOffline")
EVENT_TYPES = TRIP_EVENT_TYPES + PRESENCE_EVENT_TYPES

# ---- FIXED VALUES -------------------------------------------------------------
# Typed payload columns per event type, as (field, kind). Kinds: text, nullable (empty text
# reads as NULL), int, money decimal(12,2), coord decimal(9,6), bool, ts, dec(p,s).

EVENT_FIELDS = {
    "RideRequested": (
        ("trip_id", "text"), ("rider_id", "text"), ("city_id", "int"), ("requested_at", "ts"),
        ("pickup_lat", "coord"), ("pickup_lon", "coord"), ("pickup_zone_id", "int"),
        ("dropoff_lat", "coord"), ("dropoff_lon", "coord"), ("dropoff_zone_id", "int"),
        ("vehicle_type", "text"), ("estimated_fare", "money"),
        ("estimated_distance_km", "dec(8,2)"), ("estimated_duration_sec", "int"),
        ("surge_multiplier", "dec(4,2)"), ("payment_method", "text"), ("customer_tier", "text"),
        ("is_airport_pickup", "bool"), ("is_airport_dropoff", "bool"), ("weather_code", "text"),
        ("traffic_level", "text"), ("promo_code", "nullable"), ("device_platform", "text"),
        ("app_version", "text"),
    ),
    "RideAccepted": (
        ("trip_id", "text"), ("rider_id", "text"), ("driver_id", "text"), ("city_id", "int"),
        ("accepted_at", "ts"), ("driver_lat", "coord"), ("driver_lon", "coord"),
        ("driver_zone_id", "int"), ("vehicle_id", "text"), ("vehicle_type", "text"),
        ("matching_duration_sec", "int"), ("eta_to_pickup_sec", "int"),
        ("distance_to_pickup_km", "dec(8,2)"), ("driver_rating_at_accept", "dec(3,2)"),
        ("dispatch_attempt_number", "int"),
    ),
    "DriverArrived": (
        ("trip_id", "text"), ("rider_id", "text"), ("driver_id", "text"), ("city_id", "int"),
        ("arrived_at", "ts"), ("driver_lat", "coord"), ("driver_lon", "coord"),
        ("actual_pickup_duration_sec", "int"), ("arrival_delay_sec", "int"),
        ("is_late_arrival", "bool"),
    ),
    "RideStarted": (
        ("trip_id", "text"), ("rider_id", "text"), ("driver_id", "text"), ("city_id", "int"),
        ("started_at", "ts"), ("actual_pickup_lat", "coord"), ("actual_pickup_lon", "coord"),
        ("rider_wait_duration_sec", "int"), ("pickup_zone_id", "int"),
    ),
    "RideCompleted": (
        ("trip_id", "text"), ("rider_id", "text"), ("driver_id", "text"), ("city_id", "int"),
        ("completed_at", "ts"), ("dropoff_lat", "coord"), ("dropoff_lon", "coord"),
        ("dropoff_zone_id", "int"), ("distance_km", "dec(8,2)"), ("duration_sec", "int"),
        ("base_fare", "money"), ("distance_fare", "money"), ("time_fare", "money"),
        ("surge_multiplier", "dec(4,2)"), ("surge_amount", "money"), ("airport_fee", "money"),
        ("toll_amount", "money"), ("booking_fee", "money"), ("tax_amount", "money"),
        ("total_fare", "money"), ("driver_payout", "money"), ("platform_commission", "money"),
        ("currency", "text"), ("traffic_level", "text"), ("weather_code", "text"),
        ("payment_method", "text"),
    ),
    "RideCancelled": (
        ("trip_id", "text"), ("rider_id", "text"), ("driver_id", "text"), ("city_id", "int"),
        ("cancelled_at", "ts"), ("cancelled_by", "text"), ("cancellation_reason_code", "text"),
        ("cancelled_at_status", "text"), ("seconds_since_request", "int"),
        ("cancellation_fee", "money"), ("is_fee_charged", "bool"), ("is_driver_fault", "bool"),
        ("currency", "text"),
    ),
    "PaymentCompleted": (
        ("payment_id", "text"), ("trip_id", "text"), ("rider_id", "text"),
        ("driver_id", "text"), ("city_id", "int"), ("paid_at", "ts"),
        ("payment_method", "text"), ("payment_status", "text"), ("trip_fare", "money"),
        ("tip_amount", "money"), ("discount_amount", "money"), ("amount_charged", "money"),
        ("currency", "text"), ("promo_code", "nullable"), ("attempt_number", "int"),
        ("previous_attempt_failure_reason", "nullable"), ("gateway_reference", "text"),
    ),
    "DriverOnline": (
        ("session_id", "text"), ("driver_id", "text"), ("city_id", "int"), ("online_at", "ts"),
        ("driver_lat", "coord"), ("driver_lon", "coord"), ("zone_id", "int"),
        ("vehicle_id", "text"), ("vehicle_type", "text"), ("driver_status", "text"),
        ("device_platform", "text"), ("app_version", "text"),
    ),
    "DriverOffline": (
        ("session_id", "text"), ("driver_id", "text"), ("city_id", "int"), ("online_at", "ts"),
        ("offline_at", "ts"), ("driver_lat", "coord"), ("driver_lon", "coord"),
        ("zone_id", "int"), ("session_duration_sec", "int"),
        ("trips_completed_in_session", "int"), ("offline_reason", "text"),
    ),
}

# ---- end of fixed values ------------------------------------------------------


def event_fields(event_type: str) -> list[tuple[str, str]]:
    """(field, kind) pairs of one event type, in order."""
    return list(EVENT_FIELDS[event_type])


def text_schema(fields: list[str]) -> T.StructType:
    """All-text struct to parse a payload with, once per row."""
    return T.StructType([T.StructField(f, _s) for f in fields])
