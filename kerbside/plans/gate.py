"""The quality gate of a run: every error and warning rule over the run's own tables.

Rules on single rows of a table are counted in one pass over it; known members of dimensions
come from joins to their key columns in the same pass. Rules on keys and across tables count
violating rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.joins import key_difference
from kerbside.plans import quality
from kerbside.plans.quality import ERROR, WARN

Dims = dict[str, DataFrame]

# ---- FIXED VALUES: columns of each event type that the staging rules name ----------
NOT_NULL = {
    "RideRequested": ("trip_id", "rider_id", "city_id", "pickup_zone_id", "vehicle_type",
                      "estimated_fare", "surge_multiplier"),
    "RideAccepted": ("trip_id", "driver_id", "matching_duration_sec", "dispatch_attempt_number"),
    "DriverArrived": ("trip_id", "driver_id", "arrival_delay_sec"),
    "RideStarted": ("trip_id", "driver_id", "rider_wait_duration_sec"),
    "RideCompleted": ("trip_id", "driver_id", "total_fare", "distance_km", "duration_sec"),
    "RideCancelled": ("trip_id", "cancelled_by", "cancellation_reason_code",
                      "cancelled_at_status"),
    "PaymentCompleted": ("payment_id", "trip_id", "amount_charged", "attempt_number"),
    "DriverOnline": ("event_id", "session_id", "driver_id", "zone_id"),
    "DriverOffline": ("event_id", "session_id", "session_duration_sec"),
}
UNIQUE = {
    "RideRequested": ("trip_id",),
    "RideAccepted": ("trip_id",),
    "DriverArrived": ("trip_id",),
    "RideStarted": ("trip_id",),
    "RideCompleted": ("trip_id",),
    "RideCancelled": ("trip_id",),
    "PaymentCompleted": ("payment_id", "trip_id"),
    "DriverOnline": ("session_id",),
    "DriverOffline": ("session_id",),
}
ACCEPTED = {
    "RideCompleted": {"currency": ("INR",)},
    "RideCancelled": {
        "cancelled_by": ("RIDER", "DRIVER", "SYSTEM"),
        "cancelled_at_status": ("REQUESTED", "MATCHED", "DRIVER_ARRIVED", "STARTED"),
    },
    "PaymentCompleted": {"payment_status": ("SUCCEEDED",)},
    "DriverOffline": {
        "offline_reason": ("SHIFT_END", "BREAK", "APP_CLOSED", "CONNECTION_LOST", "SUSPENDED",
                           "UNKNOWN"),
    },
}
KNOWN_MEMBERS = {
    "RideRequested": {
        "city_id": ("dim_city", "city_id"),
        "pickup_zone_id": ("dim_zone", "zone_id"),
        "dropoff_zone_id": ("dim_zone", "zone_id"),
        "vehicle_type": ("dim_vehicle_type", "vehicle_type_code"),
        "customer_tier": ("dim_customer_tier", "customer_tier_code"),
        "payment_method": ("dim_payment_method", "payment_method_code"),
        "weather_code": ("dim_weather", "weather_code"),
        "traffic_level": ("dim_traffic_level", "traffic_level_code"),
    },
    "RideCompleted": {"payment_method": ("dim_payment_method", "payment_method_code")},
    "RideCancelled": {
        "cancellation_reason_code": ("dim_cancellation_reason", "cancellation_reason_code"),
    },
    "PaymentCompleted": {"payment_method": ("dim_payment_method", "payment_method_code")},
    "DriverOnline": {
        "zone_id": ("dim_zone", "zone_id"),
        "vehicle_type": ("dim_vehicle_type", "vehicle_type_code"),
        "driver_status": ("dim_driver_status", "driver_status_code"),
    },
}
BASE_NOT_NULL = ("event_id", "event_type", "event_timestamp", "ingested_at", "partition_key",
                 "correlation_id", "payload_json")
# ---- end of fixed values ------------------------------------------------------------

ROW_RULES = {
    "RideCompleted": quality.COMPLETED_RULES,
    "PaymentCompleted": {"f3_amount_charged": quality.PAYMENT_RULES["f3_amount_charged"]},
    "RideCancelled": quality.CANCELLED_RULES,
}


def event_rules(typed: DataFrame, event_type: str, dims: Dims) -> DataFrame:
    """(rule, severity, violations) of all rules on one typed table and its first unique key."""
    rules: dict[str, Column] = {
        name: make() for name, make in ROW_RULES.get(event_type, {}).items()
    }
    for c in NOT_NULL[event_type]:
        rules[f"not_null_{event_type}_{c}"] = F.col(c).isNull()
    for c, values in ACCEPTED.get(event_type, {}).items():
        rules[f"accepted_{event_type}_{c}"] = F.col(c).isNotNull() & ~F.col(c).isin(*values)
    rows = typed
    for c, (dim, member) in KNOWN_MEMBERS.get(event_type, {}).items():
        known = dims[dim].select(F.col(member).alias(f"_key_{c}")).distinct()
        rows = rows.join(known, F.col(c) == F.col(f"_key_{c}"), "left")
        rules[f"relationship_{event_type}_{c}"] = (
            F.col(c).isNotNull() & F.col(f"_key_{c}").isNull())
    key, *others = UNIQUE[event_type]
    counted = _counted(rows, rules, key, f"unique_{event_type}_{key}")
    for c in others:
        repeated = quality.unique(typed.where(F.col(c).isNotNull()), [c])
        counted = counted.unionByName(_rows(repeated, f"unique_{event_type}_{c}", ERROR))
    return counted


def base_rules(base: DataFrame, event_types: Iterable[str], environment: str, name: str
               ) -> DataFrame:
    """Rules on the envelope of staged events, and their ids."""
    rules = {f"not_null_{name}_{c}": F.col(c).isNull() for c in BASE_NOT_NULL}
    rules[f"accepted_{name}_event_type"] = ~F.col("event_type").isin(*event_types)
    rules[f"accepted_{name}_environment"] = F.col("environment") != environment
    return _counted(base, rules, "event_id", f"unique_{name}_event_id")


def _counted(rows: DataFrame, rules: dict[str, Column], key: str, unique: str) -> DataFrame:
    """Violations of row rules, and how many values of a key repeat, from one scan.

    Counts are taken per key first, partly before the shuffle, and then added up.
    """
    per_key = rows.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(bad).alias(name) for name, bad in rules.items()])
    total = per_key.agg(
        F.count_if(F.col("_key").isNotNull() & (F.col("_rows") > 1)).alias(unique),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rules])
    return total.unpivot([], [unique, *rules], "rule", "violations").select(
        "rule", F.lit(ERROR).alias("severity"), "violations")


def _rows(df: DataFrame, rule: str, severity: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "violations")


def run_gate(
    spark: SparkSession, base: DataFrame, presence: DataFrame, typed: dict[str, DataFrame],
    trips: DataFrame, payments: DataFrame, events: DataFrame, fct_trips: DataFrame,
    dims: Dims, times: DataFrame, environment: str = "local",
) -> DataFrame:
    """(rule, severity, violations, blocks) for everything a run is about to publish.

    `trips` are assembled trips; `fct_trips`, `payments` and `events` are the rows to publish.
    """
    trip_types = [t for t in NOT_NULL if not t.startswith("Driver") or t == "DriverArrived"]
    presence_types = [t for t in NOT_NULL if t not in trip_types]
    parts = [
        base_rules(base, trip_types, environment, "trip_events"),
        base_rules(presence, presence_types, environment, "presence_events"),
    ]
    for event_type, rows in typed.items():
        parts.append(event_rules(rows, event_type, dims))
    across = {
        "f7_surge_as_quoted": (ERROR, quality.surge_as_quoted(
            typed["RideRequested"], typed["RideCompleted"])),
        "t2_lifecycle_order": (ERROR, quality.lifecycle_order(trips)),
        "s3_payment_requires_completion": (
            WARN, quality.payment_without_completion(payments, fct_trips)),
        "s4_completed_and_cancelled": (ERROR, quality.completed_and_cancelled(fct_trips)),
        "n2_trip_counts": (ERROR, key_difference(
            base.select(F.col("correlation_id").alias("trip_id")),
            fct_trips.select("trip_id"), "trip_id")),
        "n3_revenue_agrees": (ERROR, quality.revenue_agrees(fct_trips, payments)),
        "n4_every_trip_has_events": (ERROR, quality.trips_without_events(fct_trips, events)),
        "r3_offline_without_online": (WARN, quality.offline_without_online(
            typed["DriverOffline"], typed["DriverOnline"])),
        "time_dimension_complete": (ERROR, quality.time_dimension_complete(times)),
        "session_zone_is_utc": (ERROR, quality.session_zone_is_utc(spark)),
    }
    parts += [_rows(df, rule, severity) for rule, (severity, df) in across.items()]
    return quality.with_verdict(reduce(DataFrame.unionByName, parts))
