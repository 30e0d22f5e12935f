"""One row per trip from events in any order, and one row per driver session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import round_dp
from kerbside.functions.scalars import payload_sql
from kerbside.operators.running import running_totals
from kerbside.operators.staging import typed_events
from kerbside.schemas import TRIP_EVENT_TYPES, event_fields, text_schema

EXPIRY_MINUTES = 10

# Short prefix of each event type inside an assembled row.
_PREFIX = {
    "RideRequested": "req",
    "RideAccepted": "acc",
    "DriverArrived": "arr",
    "RideStarted": "sta",
    "RideCompleted": "com",
    "RideCancelled": "can",
    "PaymentCompleted": "pay",
}

# ---- FIXED VALUES -------------------------------------------------------------
# Which event supplies an assembled column: (field, column) pairs.
_TAKEN = {
    "req": (
        ("requested_at", "requested_at"), ("pickup_lat", "pickup_lat"),
        ("pickup_lon", "pickup_lon"), ("pickup_zone_id", "pickup_zone_id"),
        ("dropoff_lat", "dropoff_lat"), ("dropoff_lon", "dropoff_lon"),
        ("dropoff_zone_id", "dropoff_zone_id"), ("vehicle_type", "requested_vehicle_type"),
        ("estimated_fare", "estimated_fare"),
        ("estimated_distance_km", "estimated_distance_km"),
        ("estimated_duration_sec", "estimated_duration_sec"),
        ("surge_multiplier", "surge_multiplier"),
        ("payment_method", "requested_payment_method"), ("customer_tier", "customer_tier"),
        ("is_airport_pickup", "is_airport_pickup"),
        ("is_airport_dropoff", "is_airport_dropoff"), ("weather_code", "request_weather_code"),
        ("traffic_level", "request_traffic_level"), ("promo_code", "promo_code"),
        ("device_platform", "device_platform"), ("app_version", "app_version"),
    ),
    "acc": (
        ("accepted_at", "accepted_at"), ("vehicle_id", "vehicle_id"),
        ("vehicle_type", "delivered_vehicle_type"),
        ("matching_duration_sec", "matching_duration_sec"),
        ("eta_to_pickup_sec", "eta_to_pickup_sec"),
        ("distance_to_pickup_km", "distance_to_pickup_km"),
        ("driver_rating_at_accept", "driver_rating_at_accept"),
        ("dispatch_attempt_number", "dispatch_attempt_number"),
        ("driver_zone_id", "driver_pickup_zone_id"),
    ),
    "arr": (
        ("arrived_at", "arrived_at"),
        ("actual_pickup_duration_sec", "actual_pickup_duration_sec"),
        ("arrival_delay_sec", "arrival_delay_sec"), ("is_late_arrival", "is_late_arrival"),
    ),
    "sta": (
        ("started_at", "started_at"), ("rider_wait_duration_sec", "rider_wait_duration_sec"),
        ("actual_pickup_lat", "actual_pickup_lat"), ("actual_pickup_lon", "actual_pickup_lon"),
    ),
    "com": (
        ("completed_at", "completed_at"), ("distance_km", "distance_km"),
        ("duration_sec", "duration_sec"), ("base_fare", "base_fare"),
        ("distance_fare", "distance_fare"), ("time_fare", "time_fare"),
        ("surge_amount", "surge_amount"), ("airport_fee", "airport_fee"),
        ("toll_amount", "toll_amount"), ("booking_fee", "booking_fee"),
        ("tax_amount", "tax_amount"), ("total_fare", "total_fare"),
        ("driver_payout", "driver_payout"), ("platform_commission", "platform_commission"),
        ("currency", "currency"), ("dropoff_zone_id", "actual_dropoff_zone_id"),
        ("traffic_level", "trip_traffic_level"), ("weather_code", "trip_weather_code"),
        ("payment_method", "charged_payment_method"),
    ),
    "can": (
        ("cancelled_at", "cancelled_at"), ("cancelled_by", "cancelled_by"),
        ("cancellation_reason_code", "cancellation_reason_code"),
        ("cancelled_at_status", "cancelled_at_status"),
        ("seconds_since_request", "seconds_since_request"),
        ("cancellation_fee", "cancellation_fee"), ("is_fee_charged", "is_fee_charged"),
        ("is_driver_fault", "is_driver_fault"),
    ),
    "pay": (
        ("paid_at", "paid_at"), ("payment_id", "payment_id"),
        ("attempt_number", "payment_attempt_number"),
    ),
}

# The first event holding a value wins, in this order.
_RIDER_FROM = ("req", "acc", "arr", "sta", "com", "can", "pay")
_DRIVER_FROM = ("acc", "arr", "sta", "com", "pay", "can")
_CITY_FROM = ("req", "acc", "com", "can")
# ---- end of fixed values ------------------------------------------------------


def _wanted(event_type: str) -> list[tuple[str, str]]:
    """The fields (field, kind) of an event type that an assembled trip takes."""
    prefix = _PREFIX[event_type]
    names = {field for field, _ in _TAKEN[prefix]}
    for field, sources in (("rider_id", _RIDER_FROM), ("driver_id", _DRIVER_FROM),
                           ("city_id", _CITY_FROM), ("surge_multiplier", ("com",))):
        if prefix in sources:
            names.add(field)
    return [(f, kind) for f, kind in event_fields(event_type) if f in names]


def event_stats(base: DataFrame) -> DataFrame:
    """Event count, lateness and arrival span per trip."""
    return base.groupBy(F.col("correlation_id").alias("trip_id")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.max("lateness_sec").alias("max_lateness_sec"),
        F.bool_or("is_late_arrival_event").alias("had_late_events"),
        F.min("ingested_at").alias("first_ingested_at"),
        F.max("ingested_at").alias("last_ingested_at"),
    )


def latest_request(base: DataFrame) -> Column:
    """Newest request in the data, as a scalar; the data's own clock for expiry."""
    requested = typed_events(base, "RideRequested")
    return requested.agg(F.max("requested_at").alias("latest_request")).scalar()


def assemble_trips(base: DataFrame, horizon: Column | None = None) -> DataFrame:
    """One row per trip id seen in any event, whatever the arrival order.

    A single grouping replaces one join per event type. Of several events of one type for a
    trip, the earliest by event time and id is taken; `conflicting_events` reports them.
    """
    horizon = latest_request(base) if horizon is None else horizon
    envelope = ("correlation_id", "event_timestamp", "event_id", "lateness_sec",
                "is_late_arrival_event")
    # Parsed once a row, for the fields of its own type.
    parsed = base.where(F.col("event_type").isin(*TRIP_EVENT_TYPES)).select(
        "event_type", *envelope, *[_parsed_event(t).alias(_json(t)) for t in TRIP_EVENT_TYPES])
    # Typed once a row, below the generated roles: the grouping sorts what it takes, no JSON text.
    typed = parsed.select(
        *envelope, F.coalesce(*[F.col(_json(t))["trip_id"] for t in TRIP_EVENT_TYPES]).alias(
            "_trip_id"),
        *[_typed_event(t).alias(f"_{_PREFIX[t]}") for t in TRIP_EVENT_TYPES],
    )
    trip_id = F.col("_trip_id")

    # A row counts for the payload's trip, and for the correlation's event statistics. They
    # are the same trip unless the producer broke the key rule.
    role = F.explode(
        F.when(
            trip_id.eqNullSafe(F.col("correlation_id")),
            F.array(_role(trip_id, True, True)),
        ).otherwise(
            F.array(_role(trip_id, True, False), _role(F.col("correlation_id"), False, True))
        )
    )
    events = typed.select(
        role.alias("_role"), "lateness_sec", "is_late_arrival_event",
        *[f"_{p}" for p in _PREFIX.values()],
    ).where(F.col("_role.trip_id").isNotNull())

    grouped = events.groupBy(F.col("_role.trip_id").alias("trip_id")).agg(
        *[F.min(F.when(F.col("_role.is_attribute"), F.col(f"_{p}"))).alias(p)
          for p in _PREFIX.values()],
        F.bool_or("_role.is_attribute").alias("_has_attribute"),
        F.count_if("_role.is_counted").alias("event_count"),
        F.max(F.when(F.col("_role.is_counted"), F.col("lateness_sec"))).alias("_max_late"),
        F.bool_or(F.col("_role.is_counted") & F.col("is_late_arrival_event")).alias("_any_late"),
    )
    taken = [
        f"{prefix}.{field} AS {column}"
        for prefix, pairs in _TAKEN.items()
        for field, column in pairs
    ]
    assembled = grouped.where("_has_attribute").selectExpr(
        "trip_id",
        _first_of(_RIDER_FROM, "rider_id"),
        _first_of(_DRIVER_FROM, "driver_id"),
        _first_of(_CITY_FROM, "city_id"),
        *taken,
        "pay.attempt_number > 1 AS had_failed_attempts",
        "com.surge_multiplier AS charged_surge_multiplier",
        "event_count",
        "coalesce(_max_late, 0.0D) AS max_lateness_sec",
        "coalesce(_any_late, false) AS had_late_events",
    )
    return assembled.withColumn("latest_request", horizon)


def _role(trip_id: Column, attribute: bool, counted: bool) -> Column:
    return F.struct(
        trip_id.alias("trip_id"),
        F.lit(attribute).alias("is_attribute"),
        F.lit(counted).alias("is_counted"),
    )


def _json(event_type: str) -> str:
    return f"_json_{_PREFIX[event_type]}"


def _parsed_event(event_type: str) -> Column:
    """The payload of an event of a type as texts of the fields that a trip takes."""
    fields = sorted({"trip_id"} | {f for f, _ in _wanted(event_type)})
    return F.when(F.col("event_type") == event_type,
                  F.from_json("payload_json", text_schema(fields)))


def _typed_event(event_type: str) -> Column:
    """An event of a type, ordered by time and id, with the fields that a trip takes; NULL for other
    types."""
    typed = ", ".join(
        f"{payload_sql(f, kind, _json(event_type))} AS {f}" for f, kind in _wanted(event_type)
    )
    return F.expr(
        f"CASE WHEN event_type = '{event_type}' "
        f"THEN struct(event_timestamp, event_id, {typed}) END"
    )


def _first_of(prefixes: tuple[str, ...], field: str) -> str:
    return f"coalesce({', '.join(f'{p}.{field}' for p in prefixes)}) AS {field}"


def conflicting_events(base: DataFrame) -> DataFrame:
    """Trips with more than one distinct event of the same type."""
    return (
        base.groupBy(F.col("correlation_id").alias("trip_id"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"))
        .where(F.col("events") > 1)
    )


def derive_trip_columns(assembled: DataFrame) -> DataFrame:
    """Outcome flags, expiry, funnel stage, status, accuracy measures, sequence validity."""
    seen = {
        name: F.col(f"{name}_at").isNotNull()
        for name in ("requested", "accepted", "arrived", "started", "completed", "cancelled",
                     "paid")
    }
    cutoff = F.col("latest_request") - F.expr(f"INTERVAL {EXPIRY_MINUTES} MINUTES")
    matched = F.col("driver_id").isNotNull()
    expired = (
        seen["requested"]
        & ~seen["accepted"]
        & ~seen["cancelled"]
        & F.coalesce(F.col("requested_at") < cutoff, F.lit(False))
    )
    flagged = assembled.select(
        "*",
        seen["completed"].alias("is_completed"),
        seen["cancelled"].alias("is_cancelled"),
        seen["paid"].alias("is_paid"),
        matched.alias("is_matched"),
        expired.alias("is_expired"),
        seen["requested"].alias("has_request_event"),
        (F.col("surge_multiplier") > F.lit(1.0)).alias("is_surge_trip"),
    )

    stage = (
        F.when(F.col("is_paid"), 6)
        .when(F.col("is_completed"), 5)
        .when(seen["started"], 4)
        .when(seen["arrived"], 3)
        .when(F.col("is_matched"), 2)
        .when(F.col("has_request_event"), 1)
        .otherwise(0)
    )
    # A cancellation decides the status even when later stages exist.
    by = F.when(F.col("cancelled_by").isin("RIDER", "DRIVER"), F.col("cancelled_by")).otherwise(
        F.lit("SYSTEM")
    )
    status = (
        F.when(F.col("is_cancelled"), F.concat(F.lit("CANCELLED_"), by))
        .when(F.col("is_paid"), "PAID")
        .when(F.col("is_completed"), "COMPLETED")
        .when(seen["started"], "STARTED")
        .when(seen["arrived"], "DRIVER_ARRIVED")
        .when(F.col("is_matched"), "MATCHED")
        .when(F.col("is_expired"), "EXPIRED")
        .when(F.col("has_request_event"), "REQUESTED")
        .otherwise("UNKNOWN")
    )
    last_stage = F.coalesce(
        "paid_at", "completed_at", "cancelled_at", "started_at", "arrived_at", "accepted_at",
        "requested_at",
    )
    requires = {
        "completed": "started",
        "paid": "completed",
        "started": "accepted",
        "arrived": "accepted",
    }
    valid = F.col("has_request_event") & ~(F.col("is_completed") & F.col("is_cancelled"))
    for later, earlier in requires.items():
        valid = valid & (~seen[later] | seen[earlier])

    return flagged.select(
        "*",
        stage.alias("funnel_stage_reached"),
        status.alias("ride_status_code"),
        (F.unix_seconds(last_stage) - F.unix_seconds("requested_at")).alias("total_lifecycle_sec"),
        _deviation_pct("total_fare", "estimated_fare").alias("estimate_accuracy_pct"),
        _deviation_pct("distance_km", "estimated_distance_km").alias("distance_accuracy_pct"),
        F.when(
            F.col("eta_to_pickup_sec") > 0,
            round_dp(
                (F.col("actual_pickup_duration_sec") - F.col("eta_to_pickup_sec")).cast("double")
                * F.lit(100.0)
                / F.col("eta_to_pickup_sec").cast("double"),
                2,
            ),
        ).alias("eta_accuracy_pct"),
        F.when(
            F.col("distance_km") > 0,
            round_dp(F.col("total_fare").cast("double") / F.col("distance_km").cast("double"), 2),
        ).alias("revenue_per_km"),
        valid.alias("is_sequence_valid"),
    )


def _deviation_pct(actual: str, expected: str) -> Column:
    gap = (F.col(actual) - F.col(expected)).cast("double")
    return F.when(
        F.col(expected) > 0, round_dp(gap / F.col(expected).cast("double") * F.lit(100.0), 2)
    )


def flag_quarantine(trips: DataFrame) -> DataFrame:
    """Mark trips that business metrics must leave out; nothing is dropped."""
    return trips.withColumn(
        "is_quarantined", ~F.col("has_request_event") | ~F.col("is_sequence_valid")
    )


def quarantined(trips: DataFrame) -> DataFrame:
    """Quarantined trips of the trip fact, with the reason."""
    reason = F.when(
        ~F.col("has_request_event"),
        "no request event landed, so the trip has no request attributes",
    ).otherwise("the order of lifecycle events is contradictory")
    return trips.where("is_quarantined").select(
        "trip_id",
        "ride_status_id",
        "requested_at",
        "total_fare",
        (~F.col("has_request_event")).alias("missing_request_event"),
        (~F.col("is_sequence_valid")).alias("invalid_sequence"),
        reason.alias("quarantine_reason"),
        "event_count",
        "max_lateness_sec",
    )


def trips_from_base(base: DataFrame, horizon: Column | None = None) -> DataFrame:
    """Assembled trips with all derived columns."""
    return flag_quarantine(derive_trip_columns(assemble_trips(base, horizon)))


# ---- sessions -------------------------------------------------------------------


def pair_sessions(online: DataFrame, offline: DataFrame) -> DataFrame:
    """Each Online with its Offline; an unmatched Online stays open."""
    on, off = online.alias("on"), offline.alias("off")
    return on.join(off, F.col("on.session_id") == F.col("off.session_id"), "left").select(
        "on.session_id", "on.driver_id", "on.city_id", "on.vehicle_id", "on.vehicle_type",
        "on.driver_status", "on.device_platform", "on.app_version", "on.online_at",
        "off.offline_at",
        F.col("on.zone_id").alias("online_zone_id"),
        F.col("off.zone_id").alias("offline_zone_id"),
        F.col("on.driver_lat").alias("online_lat"),
        F.col("on.driver_lon").alias("online_lon"),
        F.col("off.driver_lat").alias("offline_lat"),
        F.col("off.driver_lon").alias("offline_lon"),
        "off.offline_reason",
        "off.session_duration_sec",
        F.col("off.trips_completed_in_session").alias("reported_trips_completed"),
    )


_SESSION_MEASURES = (
    "dispatched_trips", "observed_trips_completed", "revenue_in_session", "payout_in_session",
    "on_trip_seconds",
)


def session_totals(sessions: DataFrame, trips: DataFrame) -> DataFrame:
    """Trips dispatched inside each session's [online_at, offline_at), summed.

    A session's total is the driver's running total at its end minus the one at its start.
    No session is paired with a trip, so a driver with very many of both costs n log n.
    """
    work = trips.where(F.col("accepted_at").isNotNull() & F.col("driver_id").isNotNull()).select(
        "driver_id",
        F.col("accepted_at").alias("at"),
        F.lit(1).alias("kind"),
        F.col("trip_id").alias("id"),
        F.lit(1).cast("bigint").alias("dispatched_trips"),
        F.col("completed_at").isNotNull().cast("bigint").alias("observed_trips_completed"),
        F.col("total_fare").cast("decimal(18,2)").alias("revenue_in_session"),
        F.col("driver_payout").cast("decimal(18,2)").alias("payout_in_session"),
        F.col("duration_sec").cast("bigint").alias("on_trip_seconds"),
    )
    # Boundaries sort before trips of the same instant: a start includes them, an end does not.
    windows = sessions.where(F.col("driver_id").isNotNull() & F.col("online_at").isNotNull())
    far = F.lit("9999-01-01 00:00:00").cast("timestamp")
    edges = windows.select(
        "driver_id",
        F.explode(
            F.array(
                F.struct(F.col("online_at").alias("at"), F.lit(-1).alias("sign")),
                F.struct(F.coalesce("offline_at", far).alias("at"), F.lit(1).alias("sign")),
            )
        ).alias("edge"),
        F.col("session_id").alias("id"),
    ).select(
        "driver_id",
        F.col("edge.at").alias("at"),
        F.lit(0).alias("kind"),
        F.concat_ws("|", F.col("id"), F.col("edge.sign").cast("string")).alias("id"),
        *[F.lit(None).cast(work.schema[m].dataType).alias(m) for m in _SESSION_MEASURES],
        F.col("id").alias("session_id"),
        F.col("edge.sign").alias("sign"),
    )
    timeline = work.withColumns(
        {"session_id": F.lit(None).cast("string"), "sign": F.lit(None).cast("int")}
    ).unionByName(edges)
    running = running_totals(
        timeline.select("driver_id", "at", "kind", "id", "session_id", "sign", *_SESSION_MEASURES)
        .withColumnsRenamed({m: f"_{m}" for m in _SESSION_MEASURES}),
        "driver_id",
        "at",
        ("kind", "id"),
        {m: F.col(f"_{m}") for m in _SESSION_MEASURES},
    ).where(F.col("sign").isNotNull())
    # An end before its start holds nothing, not a negative amount.
    return running.groupBy("session_id").agg(
        *[F.sum(F.col("sign") * F.col(m)).alias(m) for m in _SESSION_MEASURES],
        (F.max(F.when(F.col("sign") == -1, F.col("at")))
         >= F.max(F.when(F.col("sign") == 1, F.col("at")))).alias("_empty"),
    ).select(
        "session_id",
        *[
            F.when(F.col("_empty"), F.lit(0)).otherwise(F.col(m)).alias(m)
            for m in _SESSION_MEASURES
        ],
    )


def assemble_sessions(online: DataFrame, offline: DataFrame, trips: DataFrame) -> DataFrame:
    """One row per session with the work dispatched in it and its ratios."""
    sessions = pair_sessions(online, offline)
    totals = session_totals(sessions, trips)
    joined = sessions.join(totals, "session_id", "left").withColumns(
        {m: F.coalesce(F.col(m), F.lit(0)) for m in _SESSION_MEASURES}
    )
    seconds = F.col("session_duration_sec").cast("double")
    return joined.select(
        "*",
        F.col("offline_at").isNull().alias("is_session_open"),
        F.when(
            F.col("session_duration_sec") > 0,
            round_dp(F.col("observed_trips_completed").cast("double") * 3600.0 / seconds, 2),
        ).alias("trips_per_online_hour"),
        F.when(
            F.col("session_duration_sec") > 0,
            round_dp(F.col("on_trip_seconds").cast("double") * 100.0 / seconds, 2),
        ).alias("utilisation_pct"),
        (F.col("offline_zone_id") != F.col("online_zone_id")).alias("zone_drift"),
    )
