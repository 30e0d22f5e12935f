"""Quality rules and the gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.bindings.marts import Marts
from kerbside.bindings.oracle import columns, query
from kerbside.bindings.queries import register
from kerbside.plans import fingerprints as P
from kerbside.plans import quality as Q
from kerbside.schemas import EVENT_TYPES

_SUM = ("base_fare + distance_fare + time_fare + surge_amount + airport_fee + toll_amount + "
        "booking_fee + tax_amount")

register(
    "rule_unique_event_id_in_landing",
    query("SELECT event_id, count(*) AS copies FROM trip_landing GROUP BY 1 HAVING count(*) > 1"),
)(lambda m: Q.unique(m.landing, ["event_id"]))
register(
    "rule_not_null_requested",
    query("SELECT trip_id FROM req WHERE trip_id IS NULL OR rider_id IS NULL OR city_id IS NULL "
          "OR pickup_zone_id IS NULL OR vehicle_type IS NULL OR estimated_fare IS NULL "
          "OR surge_multiplier IS NULL", "req"),
)(lambda m: Q.not_null(
    m.typed("RideRequested"),
    ["trip_id", "rider_id", "city_id", "pickup_zone_id", "vehicle_type", "estimated_fare",
     "surge_multiplier"],
).select("trip_id"))
register(
    "rule_accepted_driver_status",
    query("SELECT session_id, driver_status FROM onl WHERE driver_status NOT IN ('AVAILABLE', "
          "'EN_ROUTE', 'ON_TRIP', 'BREAK', 'OFFLINE', 'SUSPENDED')", "onl"),
)(lambda m: Q.accepted_values(
    m.typed("DriverOnline"), "driver_status",
    ["AVAILABLE", "EN_ROUTE", "ON_TRIP", "BREAK", "OFFLINE", "SUSPENDED"],
).select("session_id", "driver_status"))
register(
    "rule_relationship_pickup_zone",
    query("SELECT trip_id, pickup_zone_id FROM req WHERE pickup_zone_id IS NOT NULL AND "
          "NOT EXISTS (SELECT 1 FROM dim_zone z WHERE z.zone_id = req.pickup_zone_id)",
          "req", "dim_zone"),
)(lambda m: Q.relationships(
    m.typed("RideRequested"), "pickup_zone_id", m.dims["dim_zone"], "zone_id"
).select("trip_id", "pickup_zone_id"))
register(
    "rule_fare_components",
    query(f"SELECT trip_id, cast(total_fare AS double) AS total_fare, cast({_SUM} AS double) "
          f"AS fare_component_sum, cast(abs({_SUM} - total_fare) AS double) AS drift FROM com "
          f"WHERE abs({_SUM} - total_fare) > 0.01", "com"),
)(lambda m: Q.fare_components(m.typed("RideCompleted")))
register(
    "rule_payout_split",
    query("SELECT trip_id, cast(driver_payout AS double) AS driver_payout, "
          "cast(platform_commission AS double) AS platform_commission, "
          "cast(driver_payout + platform_commission AS double) AS payout_split_sum, "
          "cast(total_fare - tax_amount AS double) AS pre_tax_subtotal, "
          "cast(abs(driver_payout + platform_commission - total_fare + tax_amount) AS double) "
          "AS drift FROM com "
          "WHERE abs(driver_payout + platform_commission - total_fare + tax_amount) > 0.01",
          "com"),
)(lambda m: Q.payout_split(m.typed("RideCompleted")))
_CHARGED = ("trip_fare", "tip_amount", "discount_amount", "amount_charged")
_EXPECTED = "trip_fare + tip_amount - discount_amount"
register(
    "rule_payment_amount",
    query(f"SELECT payment_id, trip_id, {columns(_CHARGED)}, "
          f"cast({_EXPECTED} AS double) AS expected_amount_charged FROM pay "
          f"WHERE abs({_EXPECTED} - amount_charged) > 0.01 OR amount_charged <= 0", "pay"),
)(lambda m: Q.payment_amounts(m.typed("PaymentCompleted")))
# FIXED VALUES: amounts of a completed ride that may not be negative.
_AMOUNTS = ("base_fare", "distance_fare", "time_fare", "surge_amount", "airport_fee",
            "toll_amount", "tax_amount", "driver_payout", "platform_commission")
_NEG = " UNION ALL ".join(
    f"SELECT trip_id, '{c}' AS column_name, cast({c} AS double) AS value FROM com WHERE {c} < 0"
    for c in _AMOUNTS
)
register(
    "rule_negative_money",
    query(f"{_NEG} UNION ALL SELECT trip_id, 'total_fare', cast(total_fare AS double) FROM com "
          "WHERE total_fare <= 0 UNION ALL SELECT trip_id, 'cancellation_fee', "
          "cast(cancellation_fee AS double) FROM can WHERE cancellation_fee < 0", "com", "can"),
)(lambda m: Q.negative_money(m.typed("RideCompleted"), m.typed("RideCancelled")))
register(
    "rule_surge_amount",
    query("SELECT trip_id, cast(surge_amount AS double) AS surge_amount, "
          "cast(surge_multiplier AS double) AS surge_multiplier FROM com WHERE abs(surge_amount - "
          "(base_fare + distance_fare + time_fare) * (surge_multiplier - 1)) > 0.01", "com"),
)(lambda m: Q.surge_amounts(m.typed("RideCompleted")))
register(
    "rule_surge_as_quoted",
    query("SELECT trip_id, cast(quoted AS double) AS quoted_surge, cast(charged AS double) AS "
          "charged_surge FROM (SELECT trip_id, max(quoted) AS quoted, max(charged) AS charged FROM "
          "(SELECT trip_id, surge_multiplier AS quoted, NULL AS charged FROM req UNION ALL "
          "SELECT trip_id, NULL, surge_multiplier FROM com) GROUP BY trip_id) "
          "WHERE quoted != charged", "req", "com"),
)(lambda m: Q.surge_as_quoted(m.typed("RideRequested"), m.typed("RideCompleted")))
register(
    "rule_lifecycle_order",
    query("SELECT * FROM (SELECT trip_id, max(requested_at) AS requested_at, max(accepted_at) AS "
          "accepted_at, max(arrived_at) AS arrived_at, max(started_at) AS started_at, "
          "max(completed_at) AS completed_at, max(paid_at) AS paid_at FROM ("
          "SELECT trip_id, requested_at FROM req UNION ALL BY NAME "
          "SELECT trip_id, accepted_at FROM acc UNION ALL BY NAME "
          "SELECT trip_id, arrived_at FROM arr UNION ALL BY NAME "
          "SELECT trip_id, started_at FROM sta UNION ALL BY NAME "
          "SELECT trip_id, completed_at FROM com UNION ALL BY NAME "
          "SELECT trip_id, paid_at FROM pay) GROUP BY trip_id) "
          "WHERE accepted_at <= requested_at OR arrived_at <= accepted_at "
          "OR started_at < arrived_at OR completed_at <= started_at OR paid_at < completed_at",
          "req", "acc", "arr", "sta", "com", "pay"),
)(lambda m: Q.lifecycle_order(m.trips))
register(
    "rule_driver_nullability",
    query("SELECT trip_id, cancelled_at_status, driver_id, CASE WHEN driver_id IS NULL "
          "THEN 'driver missing after a match' ELSE 'driver present before any match' END "
          "AS violation FROM can WHERE (driver_id IS NULL AND cancelled_at_status != 'REQUESTED') "
          "OR (driver_id IS NOT NULL AND cancelled_at_status = 'REQUESTED')", "can"),
)(lambda m: Q.driver_nullability(m.typed("RideCancelled")))
register(
    "rule_payment_without_completion",
    query("SELECT trip_id, fp.payment_id, cast(amount_charged AS double) AS amount_charged FROM fp "
          "JOIN ft USING (trip_id) WHERE ft.completed_at IS NULL", "ft", "fp"),
)(lambda m: Q.payment_without_completion(
    m.once("fct_payments", "trips"), m.once("fct_trips", "trips")))
register(
    "rule_completed_and_cancelled",
    query("SELECT trip_id, max(completed_at) AS completed_at, max(cancelled_at) AS cancelled_at "
          "FROM (SELECT trip_id, completed_at FROM com UNION ALL BY NAME SELECT trip_id, "
          "cancelled_at FROM can) GROUP BY trip_id "
          "HAVING max(completed_at) IS NOT NULL AND max(cancelled_at) IS NOT NULL", "com", "can"),
)(lambda m: Q.completed_and_cancelled(m.trips))

# Facts with known gaps, so that the reconciliation rules have something to find.


def _some_trips(m: Marts) -> DataFrame:
    return m.fct_trips.where(~F.col("trip_id").endswith("77"))


register(
    "rule_trip_counts",
    query("SELECT DISTINCT 'missing_from_right' AS issue, correlation_id AS trip_id FROM base "
          "WHERE correlation_id LIKE '%77'", "base"),
)(lambda m: Q.trip_counts(m.base, _some_trips(m)))
register(
    "rule_staged_equals_landed",
    query("SELECT (SELECT count(DISTINCT event_id) FROM trip_landing) AS distinct_landed, "
          "(SELECT count(*) FROM base) AS staged WHERE (SELECT count(DISTINCT event_id) FROM "
          "trip_landing) != (SELECT count(*) FROM base)", "base"),
)(lambda m: Q.staged_equals_landed(m.landing, m.base))
register(
    "rule_revenue_agrees",
    query("SELECT trip_id, cast(total_fare AS double) AS trip_side, cast(trip_fare + tip_amount "
          "AS double) AS payment_side, cast(abs(total_fare - trip_fare - tip_amount) AS double) "
          "AS drift FROM ft JOIN fp USING (trip_id) "
          "WHERE abs(total_fare - trip_fare - tip_amount) > 0.01", "ft", "fp"),
)(lambda m: Q.revenue_agrees(
    m.fct_trips, m.fct_payments.withColumn("trip_fare", F.col("trip_fare") + F.col("tip_amount"))
))
register(
    "rule_trips_without_events",
    query("SELECT trip_id, ride_status_id, event_count FROM ft WHERE NOT EXISTS (SELECT 1 FROM fe "
          "WHERE fe.trip_id = ft.trip_id AND fe.event_type = 'RideRequested')", "ft", "fe"),
)(lambda m: Q.trips_without_events(
    m.once("fct_trips", "trips"),
    m.once("fct_trip_events").where(F.col("event_type") == "RideRequested"),
))
register(
    "rule_offline_without_online",
    query("SELECT session_id, driver_id, offline_at FROM off WHERE NOT EXISTS "
          "(SELECT 1 FROM onl WHERE onl.session_id = off.session_id)", "onl", "off"),
)(lambda m: Q.offline_without_online(m.typed("DriverOffline"), m.typed("DriverOnline")))
# Minutes of the day no request has used yet.
register(
    "rule_minutes_missing_from_use",
    query("SELECT count(*) AS actual_rows, count(DISTINCT time_id) AS distinct_keys FROM "
          "(SELECT request_time_id AS time_id FROM ft WHERE request_time_id IS NOT NULL) HAVING "
          "count(*) != 1440 OR count(DISTINCT time_id) != 1440", "ft"),
)(lambda m: Q.time_dimension_complete(
    m.once("fct_trips", "trips").where("request_time_id IS NOT NULL").select(
        F.col("request_time_id").alias("time_id"))
))
register(
    "rule_dangling_causation",
    query("SELECT event_id, event_type, correlation_id, causation_id FROM base "
          "QUALIFY causation_id IS NOT NULL AND NOT "
          "list_contains(list(event_id) OVER (PARTITION BY correlation_id), causation_id)", "base"),
)(lambda m: Q.dangling_causation(m.base))
register(
    "rule_causal_order",
    query("SELECT e.event_id, id AS causation_id, e.at AS event_timestamp, caused_at, "
          "if(e.event_id = id, 'own_cause', if(e.at = caused_at, 'at_cause', 'before_cause')) AS "
          "issue FROM (SELECT id, max(caused_at) AS caused_at, unnest(list(effect) FILTER "
          "(effect IS NOT NULL)) AS e FROM (SELECT event_id AS id, event_timestamp AS caused_at, "
          "NULL AS effect FROM base UNION ALL SELECT causation_id, NULL, {'event_id': event_id, "
          "'at': event_timestamp} FROM base WHERE causation_id IS NOT NULL) GROUP BY id) "
          "WHERE e.at <= caused_at", "base"),
)(lambda m: Q.causal_order(m.base))
register(
    "rule_airport_fee",
    query("SELECT trip_id, cast(airport_fee AS double) AS airport_fee FROM trips WHERE "
          "airport_fee > 0 AND requested_at IS NOT NULL AND "
          "NOT coalesce(is_airport_pickup OR is_airport_dropoff, false)", "trips"),
)(lambda m: Q.airport_fee_only_on_airport_trips(m.trips))
register(
    "rule_key_alignment_presence_against_driver",
    query("SELECT event_id, event_type, correlation_id AS partition_key, correlation_id FROM pbase",
          "pbase"),
)(lambda m: Q.key_alignment(m.presence.withColumn("partition_key", F.col("correlation_id"))))
register(
    "rule_one_driver_per_trip",
    query("SELECT correlation_id AS trip_id, min(d) AS lowest_driver, max(d) AS highest_driver FROM "
          "(SELECT 'city' AS correlation_id, json_extract_string(payload_json, '$.driver_id') AS d "
          "FROM base) GROUP BY 1 HAVING min(d) != max(d)", "base"),
)(lambda m: Q.one_driver_per_trip(m.base.withColumn("correlation_id", F.lit("city"))))
register(
    "rule_stored_durations",
    query("SELECT trip_id, 'matching_duration_sec' AS stored_column FROM trips WHERE "
          "abs(date_diff('second', requested_at, accepted_at) - matching_duration_sec) >= 1 "
          "UNION ALL SELECT trip_id, 'actual_pickup_duration_sec' FROM trips WHERE "
          "abs(date_diff('second', accepted_at, arrived_at) - actual_pickup_duration_sec) >= 1 "
          "UNION ALL SELECT trip_id, 'duration_sec' FROM trips WHERE "
          "abs(date_diff('second', started_at, completed_at) - duration_sec - 1) >= 1", "trips"),
)(lambda m: Q.stored_durations(m.trips.withColumn("duration_sec", F.col("duration_sec") + 1)))
register(
    "rule_earliest_copy_kept",
    query("SELECT event_id, ingested_at + INTERVAL 1 SECOND AS ingested_at, earliest FROM base JOIN "
          "(SELECT event_id, min(ingested_at) AS earliest FROM trip_landing WHERE "
          "environment = 'local' GROUP BY 1) USING (event_id)", "base"),
)(lambda m: Q.earliest_copy_kept(
    m.landing.where("environment = 'local'"),
    m.base.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 SECOND")),
))

_RULES = f"""
  SELECT rule, severity, violations, severity = 'error' AND violations > 0 AS blocks FROM (
    SELECT 'f1_fare_components' AS rule, 'error' AS severity,
      count(*) FILTER (abs({_SUM} - total_fare) > 0.01) AS violations FROM com
    UNION ALL SELECT 'f2_payout_split', 'error', count(*) FILTER (
      abs(driver_payout + platform_commission - total_fare + tax_amount) > 0.01) FROM com
    UNION ALL SELECT 'f4_negative_money', 'error', count(*) FILTER (
      {' OR '.join(f'{c} < 0' for c in _AMOUNTS)} OR total_fare <= 0) FROM com
    UNION ALL SELECT 'f5_surge_amount', 'error', count(*) FILTER (abs(surge_amount -
      (base_fare + distance_fare + time_fare) * (surge_multiplier - 1)) > 0.01) FROM com
    UNION ALL SELECT 'f3_amount_charged', 'error', count(*) FILTER (
      abs({_EXPECTED} - amount_charged) > 0.01 OR amount_charged <= 0) FROM pay
    UNION ALL SELECT 'failure_reason_iff_retry', 'error', count(*) FILTER (
      (previous_attempt_failure_reason IS NOT NULL) != (attempt_number > 1)) FROM pay
    UNION ALL SELECT 'promo_iff_discount', 'error', count(*) FILTER (
      (promo_code IS NOT NULL) != (discount_amount > 0)) FROM pay
    UNION ALL SELECT 'r2_driver_nullability', 'error', count(*) FILTER (
      (driver_id IS NULL) = (cancelled_at_status != 'REQUESTED')) FROM can
    UNION ALL SELECT 'f4_negative_fee', 'error', count(*) FILTER (cancellation_fee < 0) FROM can
    UNION ALL SELECT 's3_payment_requires_completion', 'warn', count(*)
      FROM fp JOIN ft USING (trip_id) WHERE ft.completed_at IS NULL
    UNION ALL SELECT 's4_completed_and_cancelled', 'error', count(*) FROM ft
      WHERE completed_at IS NOT NULL AND cancelled_at IS NOT NULL
    UNION ALL SELECT 'r3_offline_without_online', 'warn', count(*) FROM off WHERE NOT EXISTS
      (SELECT 1 FROM onl WHERE onl.session_id = off.session_id))"""


def gate_results(m: Marts) -> DataFrame:
    """Row rules in one pass per table, relational rules as violating rows."""
    rows = reduce(DataFrame.unionByName, [
        Q.rule_counts(m.typed("RideCompleted"), Q.COMPLETED_RULES),
        Q.rule_counts(m.typed("PaymentCompleted"), Q.PAYMENT_RULES),
        Q.rule_counts(m.typed("RideCancelled"), Q.CANCELLED_RULES),
    ]).withColumn("severity", F.lit(Q.ERROR))
    relational = Q.quality_gate({
        "s3_payment_requires_completion": (
            Q.WARN, Q.payment_without_completion(m.fct_payments, m.fct_trips)),
        "s4_completed_and_cancelled": (Q.ERROR, Q.completed_and_cancelled(m.fct_trips)),
        "r3_offline_without_online": (
            Q.WARN, Q.offline_without_online(m.typed("DriverOffline"), m.typed("DriverOnline"))),
    })
    return Q.with_verdict(rows).unionByName(relational)


register("quality_gate", query(_RULES, "com", "pay", "can", "ft", "fp", "onl", "off"))(gate_results)

# Coverage of the base by the typed tables, one of them left out on purpose.
register(
    "rule_typed_models_cover_base",
    query("SELECT event_type, count(*) AS in_base, cast(NULL AS bigint) AS in_typed FROM base "
          "WHERE event_type = 'RideStarted' GROUP BY 1", "base"),
)(lambda m: Q.typed_models_cover_base(
    m.base, {t: m.typed(t) for t in EVENT_TYPES[:7] if t != "RideStarted"}
))


# ---- reconciliation by fingerprints --------------------------------------------------
# The gaps and drifts are planted in the rows compared, so that some buckets differ.


def fingerprint_trip_counts(m: Marts) -> DataFrame:
    """Trips without a row in the fact, found through differing buckets alone."""
    held = m.fct_trips.where("NOT endswith(trip_id, '77')")
    staged = m.base.withColumnRenamed("correlation_id", "trip_id")
    # As two runs would keep it: the first state, and then what the second one replaces.
    first = P.state(held.where("city_id = 1"), "facts", "trip_id")
    again = P.state(held.where("city_id = 1"), "facts", "trip_id")
    rest = P.state(held.where("city_id <> 1"), "facts", "trip_id")
    states = P.merged([first, again, rest, P.state(staged, "staged", "trip_id")], removed=[first])
    buckets = P.differing(states, "staged", "facts")
    return Q.trip_counts(P.only_in(m.base, "correlation_id", buckets),
                         P.only_in(held, "trip_id", buckets))


register(
    "fingerprint_trip_counts",
    query("SELECT DISTINCT 'missing_from_right' AS issue, correlation_id AS trip_id FROM base "
          "WHERE correlation_id LIKE '%77'", "base"),
)(fingerprint_trip_counts)


def fingerprint_revenue(m: Marts) -> DataFrame:
    """Payments that do not settle their trip's fare, found through differing buckets alone."""
    paid = m.fct_payments.withColumn("trip_fare", F.when(
        F.col("trip_id").endswith("7"), F.col("trip_fare") + 1).otherwise(F.col("trip_fare"))
        .cast("decimal(12,2)"))
    owed = m.fct_trips.join(paid.select("trip_id"), "trip_id", "left_semi")
    states = P.merged([
        P.state(owed.withColumn("fare", F.col("total_fare")), "owed", "trip_id", ["fare"]),
        P.state(paid.withColumn("fare", F.col("trip_fare")), "paid", "trip_id", ["fare"])])
    buckets = P.differing(states, "owed", "paid")
    return Q.revenue_agrees(P.only_in(owed, "trip_id", buckets),
                            P.only_in(paid, "trip_id", buckets))


register(
    "fingerprint_revenue",
    query("SELECT trip_id, cast(total_fare AS double) AS trip_side, cast(fare AS double) AS "
          "payment_side, cast(abs(total_fare - fare) AS double) AS drift FROM ft JOIN (SELECT "
          "trip_id, trip_fare + if(trip_id LIKE '%7', 1, 0) AS fare FROM fp) USING (trip_id) "
          "WHERE abs(total_fare - fare) > 0.01", "ft", "fp"),
)(fingerprint_revenue)
