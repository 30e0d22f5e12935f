"""Quality rules, the graded gate and the per-date quality table.

A rule returns its violating rows. Rules that look at one row of one table are predicates,
so the gate counts all of a table's predicates in a single scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.functions import round_dp, safe_pct
from kerbside.operators.joins import key_difference

ERROR, WARN = "error", "warn"
TOLERANCE = 0.01

# ---- generic rules --------------------------------------------------------------


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return (
        df.where(present).groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in cols]
    return df.withColumn("null_columns", F.array_compact(F.array(*missing))).where(
        F.size("null_columns") > 0
    )


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL key is missing from the parent."""
    keys = parent.select(F.col(pk).alias(fk))
    return child.where(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


# ---- row rules on typed events --------------------------------------------------


def _off(left: str, right: str) -> Column:
    return F.abs(F.expr(left) - F.expr(right)) > F.lit(TOLERANCE).cast("decimal(4,2)")


# FIXED VALUES: amounts of a completed ride that may be zero but not negative.
_NEGATIVE = ("base_fare", "distance_fare", "time_fare", "surge_amount", "airport_fee",
             "toll_amount", "tax_amount", "driver_payout", "platform_commission")

COMPLETED_RULES = {
    "f1_fare_components": lambda: _off("fare_component_sum", "total_fare"),
    "f2_payout_split": lambda: _off("payout_split_sum", "pre_tax_subtotal"),
    "f4_negative_money": lambda: reduce(
        lambda a, b: a | b, [F.col(c) < 0 for c in _NEGATIVE], F.col("total_fare") <= 0
    ),
    "f5_surge_amount": lambda: F.abs(
        F.col("surge_amount")
        - F.expr("base_fare + distance_fare + time_fare") * (F.col("surge_multiplier") - 1)
    ) > F.lit(TOLERANCE).cast("decimal(4,2)"),
}
PAYMENT_RULES = {
    "f3_amount_charged": lambda: _off("expected_amount_charged", "amount_charged")
    | (F.col("amount_charged") <= 0),
    "failure_reason_iff_retry": lambda: F.col("previous_attempt_failure_reason").isNotNull()
    != (F.col("attempt_number") > 1),
    "promo_iff_discount": lambda: F.col("promo_code").isNotNull() != (F.col("discount_amount") > 0),
}
CANCELLED_RULES = {
    "r2_driver_nullability": lambda: F.col("driver_id").isNull()
    == (F.col("cancelled_at_status") != "REQUESTED"),
    "f4_negative_fee": lambda: F.col("cancellation_fee") < 0,
}


def violating(df: DataFrame, rules: dict, name: str) -> DataFrame:
    return df.where(rules[name]())


def rule_counts(df: DataFrame, rules: dict) -> DataFrame:
    """Violations of several row rules, counted in one pass: (rule, violations)."""
    counted = df.agg(*[F.count_if(make()).alias(name) for name, make in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


def fare_components(completed: DataFrame) -> DataFrame:
    return violating(completed, COMPLETED_RULES, "f1_fare_components").select(
        "trip_id", "total_fare", "fare_component_sum",
        F.abs(F.col("fare_component_sum") - F.col("total_fare")).alias("drift"),
    )


def payout_split(completed: DataFrame) -> DataFrame:
    return violating(completed, COMPLETED_RULES, "f2_payout_split").select(
        "trip_id", "driver_payout", "platform_commission", "payout_split_sum",
        "pre_tax_subtotal",
        F.abs(F.col("payout_split_sum") - F.col("pre_tax_subtotal")).alias("drift"),
    )


def payment_amounts(payments: DataFrame) -> DataFrame:
    return violating(payments, PAYMENT_RULES, "f3_amount_charged").select(
        "payment_id", "trip_id", "trip_fare", "tip_amount", "discount_amount",
        "amount_charged", "expected_amount_charged",
    )


def negative_money(completed: DataFrame, cancelled: DataFrame) -> DataFrame:
    """One row per negative amount (or non-positive total), from one scan per table."""
    def offenders(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
        cells = [
            F.when(bad, F.struct(F.lit(c).alias("column_name"),
                                 F.col(c).cast("decimal(12,2)").alias("value")))
            for c, bad in checks.items()
        ]
        return df.select("trip_id", F.explode(F.array_compact(F.array(*cells))).alias("c")).select(
            "trip_id", "c.column_name", "c.value"
        )

    checks = {c: F.col(c) < 0 for c in _NEGATIVE}
    checks["total_fare"] = F.col("total_fare") <= 0
    return offenders(completed, checks).unionByName(
        offenders(cancelled, {"cancellation_fee": F.col("cancellation_fee") < 0})
    )


def surge_amounts(completed: DataFrame) -> DataFrame:
    return violating(completed, COMPLETED_RULES, "f5_surge_amount").select(
        "trip_id", "surge_amount", "surge_multiplier"
    )


def driver_nullability(cancelled: DataFrame) -> DataFrame:
    return violating(cancelled, CANCELLED_RULES, "r2_driver_nullability").select(
        "trip_id", "cancelled_at_status", "driver_id",
        F.when(F.col("driver_id").isNull(), "driver missing after a match")
        .otherwise("driver present before any match").alias("violation"),
    )


# ---- rules across events of a trip ----------------------------------------------


def surge_as_quoted(requested: DataFrame, completed: DataFrame) -> DataFrame:
    quoted = requested.select("trip_id", F.col("surge_multiplier").alias("quoted_surge"))
    charged = completed.select("trip_id", F.col("surge_multiplier").alias("charged_surge"))
    return quoted.join(charged, "trip_id").where(F.col("quoted_surge") != F.col("charged_surge"))


def lifecycle_order(trips: DataFrame) -> DataFrame:
    """Assembled trips whose stage times run backwards; missing stages skip, the request too."""
    broken = [
        F.col("accepted_at") <= F.col("requested_at"),
        F.col("arrived_at") <= F.col("accepted_at"),
        F.col("started_at") < F.col("arrived_at"),
        F.col("completed_at") <= F.col("started_at"),
        F.col("paid_at") < F.col("completed_at"),
    ]
    bad = reduce(lambda a, b: a | b, [F.coalesce(b, F.lit(False)) for b in broken])
    return trips.where(bad).select(
        "trip_id", "requested_at", "accepted_at", "arrived_at", "started_at", "completed_at",
        "paid_at",
    )


def payment_without_completion(payments: DataFrame, trips: DataFrame) -> DataFrame:
    incomplete = trips.where(F.col("completed_at").isNull()).select("trip_id")
    return payments.join(incomplete, "trip_id").select("trip_id", "payment_id", "amount_charged")


def completed_and_cancelled(trips: DataFrame) -> DataFrame:
    return trips.where(
        F.col("completed_at").isNotNull() & F.col("cancelled_at").isNotNull()
    ).select("trip_id", "completed_at", "cancelled_at")


def trip_counts(base: DataFrame, trips: DataFrame) -> DataFrame:
    """Trips staged but not in the mart, or in the mart but never staged."""
    staged = base.select(F.col("correlation_id").alias("trip_id"))
    return key_difference(staged, trips.select("trip_id"), "trip_id")


def staged_equals_landed(landing: DataFrame, base: DataFrame) -> DataFrame:
    """One row when staged rows differ from the distinct landed events in scope."""
    landed = landing.select("event_id").distinct().agg(F.count(F.lit(1)).alias("distinct_landed"))
    staged = base.agg(F.count(F.lit(1))).scalar()
    return landed.withColumn("staged", staged).where(F.col("staged") != F.col("distinct_landed"))


def revenue_agrees(trips: DataFrame, payments: DataFrame) -> DataFrame:
    both = trips.select("trip_id", F.col("total_fare").alias("trip_side")).join(
        payments.select("trip_id", F.col("trip_fare").alias("payment_side")), "trip_id"
    )
    return both.withColumn("drift", F.abs(F.col("trip_side") - F.col("payment_side"))).where(
        F.col("drift") > F.lit(TOLERANCE).cast("decimal(4,2)")
    )


def trips_without_events(trips: DataFrame, events: DataFrame) -> DataFrame:
    return trips.join(events.select("trip_id"), "trip_id", "left_anti").select(
        "trip_id", "ride_status_id", "event_count"
    )


def offline_without_online(offline: DataFrame, online: DataFrame) -> DataFrame:
    return relationships(offline, "session_id", online, "session_id").select(
        "session_id", "driver_id", "offline_at"
    )


def time_dimension_complete(times: DataFrame) -> DataFrame:
    return times.agg(
        F.count(F.lit(1)).alias("actual_rows"), F.countDistinct("time_id").alias("distinct_keys")
    ).where((F.col("actual_rows") != 1440) | (F.col("distinct_keys") != 1440))


def session_zone_is_utc(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT current_timezone() AS session_timezone").where(
        F.col("session_timezone") != "UTC"
    )


def key_alignment(base: DataFrame) -> DataFrame:
    """Partition and correlation keys must equal the payload's own ids."""
    trip = F.get_json_object("payload_json", "$.trip_id")
    driver = F.get_json_object("payload_json", "$.driver_id")
    session = F.get_json_object("payload_json", "$.session_id")
    presence = F.col("event_type").isin("DriverOnline", "DriverOffline")
    bad = F.when(
        presence, (F.col("partition_key") != driver) | (F.col("correlation_id") != session)
    ).otherwise((F.col("partition_key") != trip) | (F.col("correlation_id") != trip))
    return base.where(bad).select("event_id", "event_type", "partition_key", "correlation_id")


def dangling_causation(base: DataFrame) -> DataFrame:
    """Events whose cause is no event of the same correlation."""
    causes = base.select(F.col("event_id").alias("causation_id"), "correlation_id")
    return (
        base.where(F.col("causation_id").isNotNull())
        .join(causes, ["causation_id", "correlation_id"], "left_anti")
        .select("event_id", "event_type", "correlation_id", "causation_id")
    )


def causal_order(base: DataFrame) -> DataFrame:
    """Events not later than their cause, with the issue: before it, at its time, or their own.

    Where every cause is strictly earlier no cycle is possible, so a cycle of any length has
    at least one reported event.
    """
    causes = base.select(
        F.col("event_id").alias("causation_id"), F.col("event_timestamp").alias("caused_at"),
    )
    joined = base.where(F.col("causation_id").isNotNull()).join(causes, "causation_id")
    issue = (
        F.when(F.col("event_id") == F.col("causation_id"), "own_cause")
        .when(F.col("event_timestamp") < F.col("caused_at"), "before_cause")
        .when(F.col("event_timestamp") == F.col("caused_at"), "at_cause")
    )
    return joined.select(
        "event_id", "causation_id", "event_timestamp", "caused_at", issue.alias("issue")
    ).where(F.col("issue").isNotNull())


def airport_fee_only_on_airport_trips(trips: DataFrame) -> DataFrame:
    airport = F.coalesce(F.col("is_airport_pickup") | F.col("is_airport_dropoff"), F.lit(False))
    return trips.where((F.col("airport_fee") > 0) & F.col("has_request_event") & ~airport).select(
        "trip_id", "airport_fee"
    )


def one_driver_per_trip(base: DataFrame) -> DataFrame:
    driver = F.get_json_object("payload_json", "$.driver_id")
    return (
        base.groupBy(F.col("correlation_id").alias("trip_id"))
        .agg(F.min(driver).alias("lowest_driver"), F.max(driver).alias("highest_driver"))
        .where(F.col("lowest_driver") != F.col("highest_driver"))
    )


def stored_durations(trips: DataFrame) -> DataFrame:
    """Trips whose stored durations contradict their own timestamps by a second or more."""
    def gap(later: str, earlier: str, stored: str) -> Column:
        span = (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)
        return F.coalesce(F.abs(span - F.col(stored)) >= 1, F.lit(False))

    checks = {
        "matching_duration_sec": gap("accepted_at", "requested_at", "matching_duration_sec"),
        "actual_pickup_duration_sec": gap(
            "arrived_at", "accepted_at", "actual_pickup_duration_sec"
        ),
        "duration_sec": gap("completed_at", "started_at", "duration_sec"),
    }
    names = F.array_compact(F.array(*[F.when(bad, F.lit(n)) for n, bad in checks.items()]))
    return trips.select("trip_id", F.explode(names).alias("stored_column"))


def earliest_copy_kept(landing: DataFrame, base: DataFrame) -> DataFrame:
    """Kept rows that are later than the earliest landed copy."""
    first = landing.groupBy("event_id").agg(F.min("ingested_at").alias("earliest"))
    return base.join(first, "event_id").where(F.col("ingested_at") != F.col("earliest")).select(
        "event_id", "ingested_at", "earliest"
    )


def typed_models_cover_base(base: DataFrame, typed: dict[str, DataFrame]) -> DataFrame:
    """Event types whose typed row count differs from the base."""
    expected = base.groupBy("event_type").agg(F.count(F.lit(1)).alias("in_base"))
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("in_typed")).withColumn("event_type", F.lit(t))
         for t, df in typed.items()],
    )
    return expected.join(counts, "event_type", "left").where(
        ~F.col("in_base").eqNullSafe(F.col("in_typed"))
    )


def unknown_member_exists(dims: dict[str, DataFrame]) -> DataFrame:
    """Dimensions without a -1 member."""
    checks = [
        df.agg(F.count_if(F.col(df.columns[0]) == -1).alias("members")).withColumn(
            "dimension", F.lit(name)
        )
        for name, df in dims.items()
    ]
    return reduce(DataFrame.unionByName, checks).where(F.col("members") == 0)


def zone_outside_city(zones: DataFrame, cities: DataFrame) -> DataFrame:
    """Active zones whose centroid lies outside its city's bounding box."""
    # Corners of the box, as "lon lat" pairs in the polygon text.
    corners = F.split(F.regexp_extract("bounding_box_wkt", r"\(\((.*)\)\)", 1), r",\s*")
    lons = F.transform(corners, lambda c: F.split(c, " ")[0].cast("double"))
    lats = F.transform(corners, lambda c: F.split(c, " ")[1].cast("double"))
    boxes = cities.select(
        "city_id", F.array_min(lons).alias("lon_low"), F.array_max(lons).alias("lon_high"),
        F.array_min(lats).alias("lat_low"), F.array_max(lats).alias("lat_high"),
    )
    inside = F.col("centroid_lat").between(F.col("lat_low"), F.col("lat_high")) & F.col(
        "centroid_lon"
    ).between(F.col("lon_low"), F.col("lon_high"))
    return zones.where("is_active").join(boxes, "city_id").where(~inside).select(
        "zone_id", "zone_code"
    )


def city_prices_positive(cities: DataFrame) -> DataFrame:
    prices = ("base_fare", "per_km_rate", "per_min_rate", "commission_pct", "tax_pct")
    bad = reduce(lambda a, b: a | b, [F.col(p) <= 0 for p in prices])
    return cities.where("is_active").where(bad | (F.col("max_surge_multiplier") < 1)).select(
        "city_id", "city_code"
    )


def vehicle_price_order(vehicles: DataFrame) -> DataFrame:
    """Premium must cost more than economy, bike less."""
    factor = F.col("base_fare_multiplier")
    prices = vehicles.agg(*[
        F.max(F.when(F.col("vehicle_type_code") == c, factor)).alias(c.lower())
        for c in ("ECONOMY", "PREMIUM", "BIKE")
    ])
    return prices.where(
        (F.col("premium") <= F.col("economy")) | (F.col("bike") >= F.col("economy"))
    )


# ---- gate -----------------------------------------------------------------------


def quality_gate(rules: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """(rule, severity, violations, blocks) for rules given as violating rows."""
    results = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("rule"), F.lit(severity).alias("severity"), "violations"
        )
        for name, (severity, df) in rules.items()
    ]
    return with_verdict(reduce(DataFrame.unionByName, results))


def with_verdict(counts: DataFrame) -> DataFrame:
    """Add `blocks`: an error rule with violations stops publication."""
    return counts.withColumn(
        "blocks", (F.col("severity") == ERROR) & (F.col("violations") > 0)
    )


class GateBlocked(RuntimeError):
    """Publication stopped by quality errors."""


def enforce(gate: DataFrame) -> list:
    """Raise when an error rule has violations; the result has one row per rule."""
    results = gate.collect()
    blocked = [f"{r['rule']}: {r['violations']}" for r in results if r["blocks"]]
    if blocked:
        raise GateBlocked("; ".join(blocked))
    return results


# ---- quality table --------------------------------------------------------------

# Measures that are sums over rows of one table, by the date of the row.
_FIRST_SEEN = ("requested_at", "accepted_at", "arrived_at", "started_at", "completed_at",
               "cancelled_at", "paid_at")
LATENESS = "lateness"
MEASURES = (
    "trip_events_landed", "presence_events_landed", "trips", "payments", "driver_sessions",
    "duplicate_events_remaining", "late_arrivals", "clock_skewed_events", "orphaned_trips",
    "sequence_invalid_trips", "inferred_expired_trips", "payments_without_completion",
    "unexplained_revenue", "unknown_city_keys", "unknown_vehicle_keys", "unknown_tier_keys",
    "unknown_status_keys", "open_sessions", "sessions_counts_disagree",
)


def _state(rows: DataFrame, day: Column, measures: dict[str, Column]) -> DataFrame:
    """(landed_date, measure, at, amount): sums of row values by date, in long form."""
    sums = rows.groupBy(day.alias("landed_date")).agg(
        *[F.sum(F.coalesce(v.cast("decimal(18,2)"), F.lit(0))).alias(n)
          for n, v in measures.items()])
    return sums.unpivot(["landed_date"], list(measures), "measure", "amount").select(
        "landed_date", "measure", F.lit(None).cast("bigint").alias("at"),
        F.col("amount").cast("decimal(28,2)").alias("amount"))


def event_states(base: DataFrame) -> DataFrame:
    """States of staged trip events: counters, and how many events had each lateness."""
    one = F.lit(1)
    counted = base.groupBy("landed_date", "event_id").agg(
        F.count(one).alias("copies"), F.count_if("is_late_arrival_event").alias("late"),
        F.count_if(F.col("lateness_sec") < 0).alias("skewed"))
    late = base.where("lateness_sec is not null").groupBy(
        "landed_date", F.round(F.col("lateness_sec") * 1000).cast("bigint").alias("at")
    ).agg(F.count(one).cast("decimal(28,2)").alias("amount"))
    return _state(counted, F.col("landed_date"), {
        "trip_events_landed": F.col("copies"), "late_arrivals": F.col("late"),
        "clock_skewed_events": F.col("skewed"),
        "duplicate_events_remaining": F.col("copies") - 1,
    }).unionByName(late.select("landed_date", F.lit(LATENESS).alias("measure"), "at", "amount"))


def quality_states(
    base: DataFrame, presence: DataFrame, trips: DataFrame, payments: DataFrame,
    sessions: DataFrame,
) -> DataFrame:
    """What the quality table is made of, as sums: states of disjoint rows add up.

    Lateness is kept as a count for every millisecond value, so the median stays exact.
    """
    one = F.lit(1)
    bare = F.col("completed_at").isNull()
    paid = payments.select("trip_id", "paid_at", "amount_charged").join(
        trips.select("trip_id", "completed_at"), "trip_id")
    parts = [
        event_states(base),
        _state(presence, F.col("landed_date"), {"presence_events_landed": one}),
        _state(trips, F.to_date(F.coalesce(*_FIRST_SEEN)), {
            "trips": one,
            "orphaned_trips": (~F.col("has_request_event")).cast("int"),
            "sequence_invalid_trips": (~F.col("is_sequence_valid")).cast("int"),
            "inferred_expired_trips": F.col("is_inferred_expired").cast("int"),
            "unknown_city_keys": (F.col("city_id") == -1).cast("int"),
            "unknown_vehicle_keys": (F.col("vehicle_type_id") == -1).cast("int"),
            "unknown_tier_keys": (F.col("customer_tier_id") == -1).cast("int"),
            "unknown_status_keys": (F.col("ride_status_id") == -1).cast("int"),
        }),
        _state(paid, F.to_date("paid_at"), {
            "payments": one, "payments_without_completion": bare.cast("int"),
            "unexplained_revenue": F.when(bare, F.col("amount_charged")),
        }),
        _state(sessions, F.to_date("online_at"), {
            "driver_sessions": one, "open_sessions": F.col("is_session_open").cast("int"),
            "sessions_counts_disagree": F.col("counts_disagree").cast("int"),
        }),
    ]
    return reduce(DataFrame.unionByName, parts)


def merged_states(*states: DataFrame, removed: Sequence[DataFrame] = ()) -> DataFrame:
    """States added up, less those of rows that are gone; what sums to nothing falls away."""
    parts = [*states, *(s.withColumn("amount", -F.col("amount")) for s in removed)]
    # A date on which something was seen stays, even where its counters are zero.
    return (
        reduce(DataFrame.unionByName, parts).groupBy("landed_date", "measure", "at")
        .agg(F.sum("amount").cast("decimal(28,2)").alias("amount"))
        .where((F.col("amount") != 0) | F.col("at").isNull())
    )


def quality_from_states(states: DataFrame) -> DataFrame:
    """The quality table: one row per date with anything seen on it."""
    # One row per date and lateness; the values of a date are bounded by the accepted lateness.
    # Nothing can be placed in order below a zero count, so only held values take part.
    order = Window.partitionBy("landed_date").orderBy("at")
    lateness = states.where((F.col("measure") == LATENESS) & (F.col("amount") > 0)).groupBy(
        "landed_date", "at").agg(F.sum("amount").alias("held"))
    placed = lateness.select(
        "landed_date", "at", "held", F.sum("held").over(order).alias("upto"),
        F.sum("held").over(Window.partitionBy("landed_date")).alias("all"))
    # The two middle events; one and the same where the number is odd.
    middles = [F.floor((F.col("all") + k) / 2) for k in (1, 2)]
    medians = placed.groupBy("landed_date").agg(
        *[F.max(F.when((F.col("upto") >= m) & (F.col("upto") - F.col("held") < m), F.col("at")))
          .alias(f"_m{k}") for k, m in enumerate(middles)],
        F.max("at").alias("_max"))
    sums = states.where(F.col("measure") != LATENESS).groupBy("landed_date").agg(*[
        F.coalesce(F.sum(F.when(F.col("measure") == m, F.col("amount"))), F.lit(0)).alias(m)
        for m in MEASURES])
    medians = medians.withColumnRenamed("landed_date", "_day")
    whole = sums.join(medians, F.col("landed_date").eqNullSafe(F.col("_day")), "left")
    typed = [F.col(m).cast("decimal(18,2)" if m == "unexplained_revenue" else "bigint").alias(m)
             for m in MEASURES]
    return whole.where(reduce(lambda a, b: a | b, [F.col(m) != 0 for m in MEASURES])).select(
        "landed_date", *typed, round_dp(F.col("_max") / F.lit(1000.0), 2).alias("max_lateness_sec"),
        round_dp((F.col("_m0") + F.col("_m1")) / F.lit(2000.0), 2).alias("median_lateness_sec"),
    ).select(
        "*", safe_pct(F.col("orphaned_trips"), F.col("trips"), 3).alias("orphaned_trip_pct"),
        safe_pct(F.col("sequence_invalid_trips"), F.col("trips"), 3).alias("sequence_invalid_pct"),
        safe_pct(F.col("late_arrivals"), F.col("trip_events_landed"), 3).alias("late_arrival_pct"),
    )


def pipeline_quality(
    base: DataFrame, presence: DataFrame, trips: DataFrame, payments: DataFrame,
    sessions: DataFrame,
) -> DataFrame:
    """One row per date seen in any layer: volumes, lateness, orphans, unknown keys."""
    return quality_from_states(merged_states(
        quality_states(base, presence, trips, payments, sessions)))
