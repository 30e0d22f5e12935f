"""The event contract: envelope and payload rules."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FieldRule:
    """One field: its JSON type, and bounds of numbers, text lengths, values or a pattern.

    A field that is not required may be absent; a nullable one may be null. The pattern is
    searched in the text.
    """

    name: str
    kind: str
    required: bool = True
    nullable: bool = False
    gt: float | None = None
    ge: float | None = None
    le: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    one_of: tuple[str, ...] | None = None
    pattern: str | None = None


# ---- FIXED VALUES -------------------------------------------------------------

ENVELOPE_FIELDS = (
    "event_id", "event_type", "event_version", "event_timestamp", "ingested_at",
    "partition_key", "correlation_id", "causation_id", "producer_service", "producer_version",
    "environment", "payload",
)

VEHICLE_TYPES = ("ECONOMY", "PREMIUM", "XL", "POOL", "AUTO", "BIKE")
PAYMENT_METHODS = ("CASH", "CARD", "UPI", "WALLET", "CORPORATE", "NETBANKING")
CUSTOMER_TIERS = ("BASIC", "SILVER", "GOLD", "PLATINUM")
WEATHER_CODES = (
    "CLEAR", "CLOUDY", "RAIN_LIGHT", "RAIN_HEAVY", "THUNDERSTORM", "FOG", "EXTREME_HEAT",
)
TRAFFIC_LEVELS = ("FREE_FLOW", "LIGHT", "MODERATE", "HEAVY", "GRIDLOCK")

ENVELOPE_RULES = (
    FieldRule("event_id", "string"),
    FieldRule("event_version", "string", pattern=r"^\d+\.\d+\.\d+$"),
    FieldRule("event_timestamp", "string"),
    FieldRule("ingested_at", "string"),
    FieldRule("partition_key", "string", min_length=1),
    FieldRule("correlation_id", "string"),
    FieldRule("causation_id", "string", nullable=True),
    FieldRule("producer_service", "string", pattern=r"^[a-z][a-z0-9-]{2,39}$"),
    FieldRule("producer_version", "string", pattern=r"^\d+\.\d+\.\d+$"),
    FieldRule("environment", "string", one_of=("local", "dev", "staging", "prod")),
    FieldRule("payload", "object"),
)

PAYLOAD_RULES = {
    "RideRequested": (
        FieldRule("trip_id", "string"),
        FieldRule("rider_id", "string"),
        FieldRule("city_id", "integer", ge=1),
        FieldRule("requested_at", "string"),
        FieldRule("pickup_lat", "number", ge=-90, le=90),
        FieldRule("pickup_lon", "number", ge=-180, le=180),
        FieldRule("pickup_zone_id", "integer", ge=1),
        FieldRule("dropoff_lat", "number", ge=-90, le=90),
        FieldRule("dropoff_lon", "number", ge=-180, le=180),
        FieldRule("dropoff_zone_id", "integer", ge=1),
        FieldRule("vehicle_type", "string", one_of=VEHICLE_TYPES),
        FieldRule("estimated_fare", "number", gt=0),
        FieldRule("estimated_distance_km", "number", gt=0, le=500),
        FieldRule("estimated_duration_sec", "integer", gt=0, le=43200),
        FieldRule("surge_multiplier", "number", ge=1, le=10),
        FieldRule("payment_method", "string", one_of=PAYMENT_METHODS),
        FieldRule("customer_tier", "string", one_of=CUSTOMER_TIERS),
        FieldRule("is_airport_pickup", "boolean"),
        FieldRule("is_airport_dropoff", "boolean"),
        FieldRule("weather_code", "string", one_of=WEATHER_CODES),
        FieldRule("traffic_level", "string", one_of=TRAFFIC_LEVELS),
        FieldRule("promo_code", "string", required=False, nullable=True,
                  pattern=r"^[A-Z0-9]{4,16}$"),
        FieldRule("device_platform", "string", one_of=("IOS", "ANDROID", "WEB")),
        FieldRule("app_version", "string", pattern=r"^\d+\.\d+\.\d+$"),
    ),
    "RideAccepted": (
        FieldRule("trip_id", "string"),
        FieldRule("rider_id", "string"),
        FieldRule("driver_id", "string"),
        FieldRule("city_id", "integer", ge=1),
        FieldRule("accepted_at", "string"),
        FieldRule("driver_lat", "number", ge=-90, le=90),
        FieldRule("driver_lon", "number", ge=-180, le=180),
        FieldRule("driver_zone_id", "integer", ge=1),
        FieldRule("vehicle_id", "string"),
        FieldRule("vehicle_type", "string", one_of=VEHICLE_TYPES),
        FieldRule("matching_duration_sec", "integer", ge=0),
        FieldRule("eta_to_pickup_sec", "integer", gt=0, le=3600),
        FieldRule("distance_to_pickup_km", "number", ge=0, le=100),
        FieldRule("driver_rating_at_accept", "number", ge=1, le=5),
        FieldRule("dispatch_attempt_number", "integer", ge=1),
    ),
    "DriverArrived": (
        FieldRule("trip_id", "string"),
        FieldRule("rider_id", "string"),
        FieldRule("driver_id", "string"),
        FieldRule("city_id", "integer", ge=1),
        FieldRule("arrived_at", "string"),
        FieldRule("driver_lat", "number", ge=-90, le=90),
        FieldRule("driver_lon", "number", ge=-180, le=180),
        FieldRule("actual_pickup_duration_sec", "integer", ge=0),
        FieldRule("arrival_delay_sec", "integer"),
        FieldRule("is_late_arrival", "boolean"),
    ),
    "RideStarted": (
        FieldRule("trip_id", "string"),
        FieldRule("rider_id", "string"),
        FieldRule("driver_id", "string"),
        FieldRule("city_id", "integer", ge=1),
        FieldRule("started_at", "string"),
        FieldRule("actual_pickup_lat", "number", ge=-90, le=90),
        FieldRule("actual_pickup_lon", "number", ge=-180, le=180),
        FieldRule("rider_wait_duration_sec", "integer", ge=0),
        FieldRule("pickup_zone_id", "integer", ge=1),
    ),
    "RideCompleted": (
        FieldRule("trip_id", "string"),
        FieldRule("rider_id", "string"),
        FieldRule("driver_id", "string"),
        FieldRule("city_id", "integer", ge=1),
        FieldRule("completed_at", "string"),
        FieldRule("dropoff_lat", "number", ge=-90, le=90),
        FieldRule("dropoff_lon", "number", ge=-180, le=180),
        FieldRule("dropoff_zone_id", "integer", ge=1),
        FieldRule("distance_km", "number", gt=0, le=500),
        FieldRule("duration_sec", "integer", gt=0),
        FieldRule("base_fare", "number", ge=0),
        FieldRule("distance_fare", "number", ge=0),
        FieldRule("time_fare", "number", ge=0),
        FieldRule("surge_multiplier", "number", ge=1, le=10),
        FieldRule("surge_amount", "number", ge=0),
        FieldRule("airport_fee", "number", ge=0),
        FieldRule("toll_amount", "number", ge=0),
        FieldRule("booking_fee", "number", ge=0),
        FieldRule("tax_amount", "number", ge=0),
        FieldRule("total_fare", "number", gt=0),
        FieldRule("driver_payout", "number", ge=0),
        FieldRule("platform_commission", "number", ge=0),
        FieldRule("currency", "string", pattern=r"^[A-Z]{3}$"),
        FieldRule("traffic_level", "string", one_of=TRAFFIC_LEVELS),
        FieldRule("weather_code", "string", one_of=WEATHER_CODES),
        FieldRule("payment_method", "string", one_of=PAYMENT_METHODS),
    ),
    "RideCancelled": (
        FieldRule("trip_id", "string"),
        FieldRule("rider_id", "string"),
        FieldRule("driver_id", "string", nullable=True),
        FieldRule("city_id", "integer", ge=1),
        FieldRule("cancelled_at", "string"),
        FieldRule("cancelled_by", "string", one_of=("RIDER", "DRIVER", "SYSTEM")),
        FieldRule("cancellation_reason_code", "string"),
        FieldRule("cancelled_at_status", "string",
                  one_of=("REQUESTED", "MATCHED", "DRIVER_ARRIVED", "STARTED")),
        FieldRule("seconds_since_request", "integer", ge=0),
        FieldRule("cancellation_fee", "number", ge=0),
        FieldRule("is_fee_charged", "boolean"),
        FieldRule("is_driver_fault", "boolean"),
        FieldRule("currency", "string", pattern=r"^[A-Z]{3}$"),
    ),
    "PaymentCompleted": (
        FieldRule("trip_id", "string"),
        FieldRule("rider_id", "string"),
        FieldRule("driver_id", "string"),
        FieldRule("city_id", "integer", ge=1),
        FieldRule("payment_id", "string"),
        FieldRule("paid_at", "string"),
        FieldRule("payment_method", "string", one_of=PAYMENT_METHODS),
        FieldRule("payment_status", "string", one_of=("SUCCEEDED",)),
        FieldRule("trip_fare", "number", gt=0),
        FieldRule("tip_amount", "number", ge=0),
        FieldRule("discount_amount", "number", ge=0),
        FieldRule("amount_charged", "number", gt=0),
        FieldRule("currency", "string", pattern=r"^[A-Z]{3}$"),
        FieldRule("promo_code", "string", required=False, nullable=True,
                  pattern=r"^[A-Z0-9]{4,16}$"),
        FieldRule("attempt_number", "integer", ge=1),
        FieldRule("previous_attempt_failure_reason", "string", required=False, nullable=True),
        FieldRule("gateway_reference", "string", min_length=8, max_length=64),
    ),
    "DriverOnline": (
        FieldRule("driver_id", "string"),
        FieldRule("session_id", "string"),
        FieldRule("city_id", "integer", ge=1),
        FieldRule("online_at", "string"),
        FieldRule("driver_lat", "number", ge=-90, le=90),
        FieldRule("driver_lon", "number", ge=-180, le=180),
        FieldRule("zone_id", "integer", ge=1),
        FieldRule("vehicle_id", "string"),
        FieldRule("vehicle_type", "string", one_of=VEHICLE_TYPES),
        FieldRule("driver_status", "string",
                  one_of=("AVAILABLE", "EN_ROUTE", "ON_TRIP", "BREAK", "OFFLINE", "SUSPENDED")),
        FieldRule("device_platform", "string", one_of=("IOS", "ANDROID")),
        FieldRule("app_version", "string", pattern=r"^\d+\.\d+\.\d+$"),
    ),
    "DriverOffline": (
        FieldRule("driver_id", "string"),
        FieldRule("session_id", "string"),
        FieldRule("city_id", "integer", ge=1),
        FieldRule("online_at", "string"),
        FieldRule("offline_at", "string"),
        FieldRule("driver_lat", "number", ge=-90, le=90),
        FieldRule("driver_lon", "number", ge=-180, le=180),
        FieldRule("zone_id", "integer", ge=1),
        FieldRule("session_duration_sec", "integer", gt=0),
        FieldRule("trips_completed_in_session", "integer", ge=0),
        FieldRule("offline_reason", "string",
                  one_of=("SHIFT_END", "BREAK", "APP_CLOSED", "CONNECTION_LOST",
                          "SUSPENDED", "UNKNOWN")),
    ),
}

SKEW_TOLERANCE_SECONDS = 5 * 60
MAX_LATENESS_SECONDS = 7 * 24 * 3600

REASONS = (
    "MALFORMED_JSON", "NOT_AN_OBJECT", "MISSING_ENVELOPE_FIELD", "UNKNOWN_EVENT_TYPE",
    "INVALID_VERSION", "INVALID_TIMESTAMP", "TIMESTAMP_OUT_OF_BOUNDS", "SCHEMA_VIOLATION",
)

# ---- end of fixed values ------------------------------------------------------
