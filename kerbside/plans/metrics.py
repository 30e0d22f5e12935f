"""Metric queries over the marts. Ratios are ratios of sums; quarantined trips stay out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions import round_dp, safe_pct, safe_ratio
from kerbside.operators.joins import drill_across
from kerbside.operators.quantiles import quantile_cuts

Marts = dict[str, DataFrame]

FUNNEL_STAGES = ("Requested", "Matched", "Driver arrived", "Started", "Completed", "Paid")
MIN_REQUESTS_FOR_DIAGNOSIS = 10
MIN_REQUESTS_FOR_RANKING = 50


def clean_trips(marts: Marts) -> DataFrame:
    """The trips every business metric counts."""
    return marts["fct_trips"].where(~F.col("is_quarantined"))


def _count_if(condition: Column, alias: str) -> Column:
    return F.count_if(condition).alias(alias)


def _pre_surge() -> Column:
    return F.col("base_fare") + F.col("distance_fare") + F.col("time_fare")


def _money(total: Column) -> Column:
    return F.round(total, 2).cast("decimal(18,2)")


def marketplace_health(marts: Marts) -> DataFrame:
    """Demand against supply per zone and local hour, with a diagnosis."""
    demand = (
        clean_trips(marts)
        .where(F.col("requested_at").isNotNull())
        .groupBy(F.col("pickup_zone_id").alias("zone_id"),
                 F.col("request_local_hour").alias("local_hour"))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            _count_if(~F.col("is_matched"), "unmatched"),
            _count_if(F.col("is_completed"), "completed"),
            _count_if(F.col("is_inferred_expired"), "inferred_expired"),
            round_dp(F.avg("matching_duration_sec"), 1).alias("avg_match_sec"),
            round_dp(
                safe_ratio(F.sum("surge_multiplier"), F.count("surge_multiplier")), 3
            ).alias("avg_surge_multiplier"),
        )
    )
    supply = (
        marts["fct_driver_sessions"]
        .groupBy(F.col("online_zone_id").alias("zone_id"),
                 F.expr("cast(online_time_id div 100 as smallint)").alias("local_hour"))
        .agg(
            F.count(F.lit(1)).alias("driver_sessions"),
            F.sum("observed_trips_completed").alias("trips_served"),
            round_dp(F.avg("session_duration_sec") / 3600.0, 2).alias("avg_online_hours"),
        )
    )
    zones = marts["dim_zone"].select("zone_id", "zone_name", "zone_type")
    joined = drill_across(demand, supply, ["zone_id", "local_hour"]).join(zones, "zone_id")
    unmet_share = F.col("unmatched").cast("double") / F.col("requests")
    short = unmet_share > 0.10
    return joined.select(
        "zone_name", "zone_type", "local_hour", "requests", "unmatched", "inferred_expired",
        safe_pct(F.col("unmatched"), F.col("requests")).alias("unmet_demand_pct"),
        F.coalesce("driver_sessions", F.lit(0)).alias("driver_sessions"),
        "avg_match_sec", "avg_surge_multiplier",
        F.when(F.col("requests") < MIN_REQUESTS_FOR_DIAGNOSIS, "INSUFFICIENT_DATA")
        .when(short & (F.col("avg_surge_multiplier") > 1.2), "SUPPLY_SHORTAGE")
        .when(short, "UNPRICED_SHORTAGE")
        .otherwise("HEALTHY").alias("diagnosis"),
    ).orderBy(F.col("unmet_demand_pct").desc_nulls_last(), F.col("requests").desc())


def funnel_of(trips: DataFrame) -> DataFrame:
    """Stage counts from one pass, with share of requests and step conversion."""
    reached = F.col("funnel_stage_reached")
    counts = trips.agg(
        F.count(F.lit(1)).alias("n1"),
        *[_count_if(reached >= i, f"n{i}") for i in range(2, len(FUNNEL_STAGES) + 1)],
    )
    stages = counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("stage"), F.lit(name).alias("stage_name"),
                             F.col(f"n{i}").alias("trips"))
                    for i, name in enumerate(FUNNEL_STAGES, 1)
                ]
            )
        ).alias("s")
    ).select("s.*")
    # Six rows: the single window partition is fixed in size.
    by_stage = Window.orderBy("stage")
    placed = stages.select(
        "*",
        F.first("trips").over(by_stage).alias("top"),
        F.lag("trips").over(by_stage).alias("previous"),
    )
    trips_col = F.col("trips")
    return placed.select(
        "stage", "stage_name", "trips",
        safe_pct(trips_col, F.col("top")).alias("pct_of_requests"),
        safe_pct(trips_col, F.col("previous")).alias("step_conversion_pct"),
        (F.coalesce("previous", "trips") - trips_col).alias("lost_at_this_step"),
    ).orderBy("stage")


def conversion_funnel(marts: Marts) -> DataFrame:
    return funnel_of(clean_trips(marts))


def pricing_effectiveness(marts: Marts) -> DataFrame:
    """Revenue-weighted surge against the naive mean by hour, day part and weather."""
    times = marts["dim_time"].select(F.col("time_id").alias("request_time_id"), "day_part",
                                     "is_peak_hour")
    weather = marts["dim_weather"].select(F.col("weather_id").alias("request_weather_id"),
                                          "weather_code")
    trips = clean_trips(marts).where(F.col("is_completed") & F.col("total_fare").isNotNull())
    return (
        trips.join(times, "request_time_id")
        .join(weather, "request_weather_id", "left")
        .groupBy(F.col("request_local_hour").alias("local_hour"), "day_part", "is_peak_hour",
                 "weather_code")
        .agg(
            F.count(F.lit(1)).alias("completed_trips"),
            _money(F.sum("surge_amount")).alias("surge_revenue"),
            _money(F.sum(_pre_surge())).alias("pre_surge_revenue"),
            safe_pct(F.sum("surge_amount"), F.sum(_pre_surge())).alias("weighted_surge_pct"),
            round_dp(
                safe_ratio(F.sum("surge_multiplier"), F.count("surge_multiplier")), 3
            ).alias("naive_avg_multiplier"),
            safe_pct(F.count_if("is_surge_trip"), F.count(F.lit(1))).alias("surged_trip_pct"),
            round_dp(F.avg("matching_duration_sec"), 1).alias("avg_match_sec"),
            round_dp(F.avg("eta_to_pickup_sec"), 1).alias("avg_eta_sec"),
        )
        .orderBy(F.col("weighted_surge_pct").desc_nulls_last())
    )


def financial_truth(marts: Marts) -> DataFrame:
    """Charged, collected and drift per local date."""
    charged = (
        clean_trips(marts)
        .where("is_completed")
        .groupBy(F.col("request_date_id").alias("date_id"))
        .agg(
            F.count(F.lit(1)).alias("completed_trips"),
            _money(F.sum("total_fare")).alias("gross_bookings"),
            _money(F.sum(_pre_surge())).alias("base_revenue"),
            _money(F.sum("surge_amount")).alias("surge_revenue"),
            _money(
                F.sum(F.col("airport_fee") + F.col("toll_amount") + F.col("booking_fee"))
            ).alias("fees_revenue"),
            _money(F.sum("tax_amount")).alias("tax_collected"),
            _money(F.sum("driver_payout")).alias("driver_payout"),
            _money(F.sum("platform_commission")).alias("platform_commission"),
        )
    )
    collected = (
        marts["fct_payments"]
        .groupBy(F.col("paid_date_id").alias("date_id"))
        .agg(
            F.count(F.lit(1)).alias("payments"),
            _money(F.sum("amount_charged")).alias("amount_collected"),
            _money(F.sum("tip_amount")).alias("tips"),
            _money(F.sum("discount_amount")).alias("discounts"),
            _money(F.sum("gateway_fee_amount")).alias("gateway_fees"),
        )
    )
    days = marts["dim_date"].select("date_id", "full_date", "day_name", "is_weekend")

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("decimal(18,2)"))

    joined = drill_across(charged, collected, ["date_id"]).join(days, "date_id")
    return joined.select(
        "full_date", "day_name", "is_weekend", "completed_trips", "gross_bookings",
        "base_revenue", "surge_revenue", "fees_revenue", "tax_collected", "driver_payout",
        "platform_commission", "payments", "amount_collected", "tips", "discounts",
        "gateway_fees",
        _money(
            F.col("platform_commission") - or_zero("gateway_fees") - or_zero("discounts")
        ).alias("net_platform_revenue"),
        _money(
            F.col("gross_bookings") - or_zero("amount_collected") + or_zero("tips")
            - or_zero("discounts")
        ).alias("charged_vs_collected_drift"),
    ).orderBy("full_date")


# ---- daily page -----------------------------------------------------------------


def _dated(df: DataFrame, marts: Marts, date_id: str) -> DataFrame:
    days = marts["dim_date"].select(F.col("date_id").alias("_date_id"), "full_date")
    return df.join(days, F.col(date_id) == F.col("_date_id")).drop("_date_id")


def reporting_day(marts: Marts) -> Column:
    """The latest local date with a clean trip, as a scalar."""
    return _dated(clean_trips(marts), marts, "request_date_id").agg(F.max("full_date")).scalar()


def _day_trips(marts: Marts, day: Column | None) -> DataFrame:
    day = reporting_day(marts) if day is None else day
    return _dated(clean_trips(marts), marts, "request_date_id").where(F.col("full_date") == day)


def daily_kpis(marts: Marts, day: Column | None = None) -> DataFrame:
    """The headline row of the latest reporting day."""
    return _day_trips(marts, day).groupBy("full_date").agg(
        F.count(F.lit(1)).alias("requested"),
        _count_if(F.col("is_completed"), "completed"),
        _count_if(~F.col("is_matched"), "unmatched"),
        _money(F.sum("total_fare")).alias("gross"),
        _money(F.sum("platform_commission")).alias("commission"),
        _money(F.sum("driver_payout")).alias("payout"),
        _money(F.sum("tax_amount")).alias("tax"),
        _money(F.sum("surge_amount")).alias("surge"),
        _money(F.sum(_pre_surge())).alias("presurge"),
    )


def hourly_demand(marts: Marts, day: Column | None = None, all_days: bool = False) -> DataFrame:
    trips = clean_trips(marts) if all_days else _day_trips(marts, day)
    return trips.groupBy(F.col("request_local_hour").alias("local_hour")).agg(
        F.count(F.lit(1)).alias("n")
    )


def hourly_supply(marts: Marts, day: Column | None = None, all_days: bool = False) -> DataFrame:
    sessions = marts["fct_driver_sessions"]
    if not all_days:
        day = reporting_day(marts) if day is None else day
        sessions = _dated(sessions, marts, "online_date_id").where(F.col("full_date") == day)
    return sessions.groupBy(
        F.expr("cast(online_time_id div 100 as smallint)").alias("local_hour")
    ).agg(F.count(F.lit(1)).alias("n"))


def hourly_curve(marts: Marts, day: Column | None = None, all_days: bool = False) -> DataFrame:
    """Requests and sessions starting in each local hour."""
    demand = hourly_demand(marts, day, all_days).select(F.lit("demand").alias("series"),
                                                        "local_hour", "n")
    supply = hourly_supply(marts, day, all_days).select(F.lit("supply").alias("series"),
                                                        "local_hour", "n")
    return demand.unionByName(supply)


def indexed_curve(curve: DataFrame) -> DataFrame:
    """Each series as shares of its own total over 24 dense hours, peak hour marked."""
    known = curve.where(F.col("local_hour").isNotNull())
    hours = (
        known.select("series").distinct()
        .select("series", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("local_hour"))
    )
    dense = hours.join(known, ["series", "local_hour"], "left")
    # 24 rows per series.
    whole = Window.partitionBy("series")
    # Rows without a local hour still belong to the total.
    totals = curve.groupBy("series").agg(F.sum("n").alias("_total"))
    share = F.lit(100.0) * F.coalesce("n", F.lit(0)) / F.greatest(F.col("_total"), F.lit(1))
    shared = dense.join(totals, "series").select("series", "local_hour",
                                                 share.alias("pct_of_total"))
    peak = F.max(F.struct(F.col("pct_of_total"), -F.col("local_hour"))).over(whole)
    return shared.select(
        "series", "local_hour", round_dp(F.col("pct_of_total"), 6).alias("pct_of_total"),
        (F.col("local_hour") == -peak.getField("col2")).alias("is_peak_hour"),
    )


def unmet_by_zone(marts: Marts, day: Column | None = None, all_days: bool = False,
                  k: int = 10) -> DataFrame:
    """Zones with the largest unmet share among those with enough requests."""
    trips = clean_trips(marts) if all_days else _day_trips(marts, day)
    zones = marts["dim_zone"].select(F.col("zone_id").alias("pickup_zone_id"), "zone_name")
    per_zone = (
        trips.join(zones, "pickup_zone_id")
        .groupBy("zone_name")
        .agg(
            safe_pct(F.count_if(~F.col("is_matched")), F.count(F.lit(1)), 1).alias("pct"),
            F.count(F.lit(1)).alias("requests"),
        )
        .where(F.col("requests") >= MIN_REQUESTS_FOR_RANKING)
    )
    return top_k(per_zone, [F.col("pct").desc(), F.col("zone_name")], k)


def top_k(df: DataFrame, by: list[Column], k: int) -> DataFrame:
    """The k leading rows; each task keeps k rows before the final merge."""
    return df.orderBy(*by).limit(k)


def surge_by_hour(marts: Marts, day: Column | None = None, all_days: bool = False) -> DataFrame:
    trips = clean_trips(marts) if all_days else _day_trips(marts, day)
    return (
        trips.where("is_completed")
        .groupBy(F.col("request_local_hour").alias("local_hour"))
        .agg(safe_pct(F.sum("surge_amount"), F.sum(_pre_surge()), 1).alias("weighted_surge_pct"))
        .orderBy("local_hour")
    )


def quality_trend(quality: DataFrame) -> DataFrame:
    return quality.select(
        "landed_date",
        (F.col("trip_events_landed") + F.col("presence_events_landed")).alias("landed"),
        "duplicate_events_remaining", "late_arrivals", "clock_skewed_events", "orphaned_trips",
        "sequence_invalid_trips", "unexplained_revenue",
    ).orderBy("landed_date")


def quarantine_count(marts: Marts) -> DataFrame:
    return marts["fct_trips"].agg(_count_if(F.col("is_quarantined"), "quarantined_trips"))


# ---- measure registry -----------------------------------------------------------

# measure: (fact, aggregate). The registry filters quarantine, callers cannot forget it.
_TRIP, _PAY, _SESSION = "fct_trips", "fct_payments", "fct_driver_sessions"


def _base_measures() -> dict[str, tuple[str, Column]]:
    return {
        "trips_requested": (_TRIP, F.count(F.lit(1))),
        "trips_completed": (_TRIP, F.count_if("is_completed")),
        "trips_cancelled": (_TRIP, F.count_if("is_cancelled")),
        "trips_unmatched": (_TRIP, F.count_if(~F.col("is_matched"))),
        "gross_bookings": (_TRIP, _money(F.sum("total_fare"))),
        "driver_payout": (_TRIP, _money(F.sum("driver_payout"))),
        "platform_commission": (_TRIP, _money(F.sum("platform_commission"))),
        "surge_revenue": (_TRIP, _money(F.sum("surge_amount"))),
        "pre_surge_revenue": (_TRIP, _money(F.sum(_pre_surge()))),
        "amount_collected": (_PAY, _money(F.sum("amount_charged"))),
        "gateway_fees": (_PAY, _money(F.sum("gateway_fee_amount"))),
        "discounts": (_PAY, _money(F.sum("discount_amount"))),
        "driver_sessions": (_SESSION, F.count(F.lit(1))),
        "online_hours": (_SESSION, F.sum("session_duration_sec").cast("double") / 3600.0),
    }


def _ratio_measures() -> dict[str, tuple[tuple[str, ...], Column]]:
    col = F.col
    zero = F.lit(0).cast("decimal(18,2)")
    return {
        "completion_rate_pct": (("trips_completed", "trips_requested"),
                                safe_pct(col("trips_completed"), col("trips_requested"))),
        "cancellation_rate_pct": (("trips_cancelled", "trips_requested"),
                                  safe_pct(col("trips_cancelled"), col("trips_requested"))),
        "unmet_demand_pct": (("trips_unmatched", "trips_requested"),
                             safe_pct(col("trips_unmatched"), col("trips_requested"))),
        "weighted_surge_pct": (("surge_revenue", "pre_surge_revenue"),
                               safe_pct(col("surge_revenue"), col("pre_surge_revenue"))),
        "net_platform_revenue": (
            ("platform_commission", "gateway_fees", "discounts"),
            _money(col("platform_commission") - F.coalesce("gateway_fees", zero)
                   - F.coalesce("discounts", zero)),
        ),
        "trips_per_online_hour": (("trips_completed", "online_hours"),
                                  round_dp(safe_ratio(col("trips_completed"),
                                                      col("online_hours")), 4)),
    }


MEASURES = (
    "trips_requested", "trips_completed", "trips_cancelled", "trips_unmatched", "gross_bookings",
    "driver_payout", "platform_commission", "surge_revenue", "pre_surge_revenue",
    "amount_collected", "gateway_fees", "discounts", "driver_sessions", "online_hours",
    "completion_rate_pct", "cancellation_rate_pct", "unmet_demand_pct", "weighted_surge_pct",
    "net_platform_revenue", "trips_per_online_hour",
)

# Column each fact uses for a shared grain.
_GRAIN = {
    "date_id": {_TRIP: "request_date_id", _PAY: "paid_date_id", _SESSION: "online_date_id"},
    "city_id": {_TRIP: "city_id", _PAY: "city_id", _SESSION: "city_id"},
    "driver_id": {_TRIP: "driver_id", _PAY: "driver_id", _SESSION: "driver_id"},
}


def measures(marts: Marts, names: list[str], by: list[str]) -> DataFrame:
    """Named measures at a shared grain; every fact is aggregated before joining.

    Payments leave out quarantined trips through their own flag, so money terms of both
    sides cover the same trips.
    """
    base, ratios = _base_measures(), _ratio_measures()
    needed = list(
        dict.fromkeys(
            part for n in names for part in (ratios[n][0] if n in ratios else (n,))
        )
    )
    sides = []
    for fact in (_TRIP, _PAY, _SESSION):
        wanted = {n: base[n][1] for n in needed if base[n][0] == fact}
        if not wanted:
            continue
        rows = marts[fact]
        if "is_quarantined" in rows.columns:
            rows = rows.where(~F.coalesce("is_quarantined", F.lit(False)))
        keys = [F.col(_GRAIN[k][fact]).alias(k) for k in by]
        sides.append(
            rows.groupBy(*keys).agg(*[c.alias(n) for n, c in wanted.items()])
        )
    grains = sides[0].select(*by)
    for side in sides[1:]:
        grains = grains.unionByName(side.select(*by))
    joined = grains.where(F.col(by[0]).isNotNull()).distinct()
    for side in sides:
        joined = drill_across(joined, side, by)
    return joined.select(*by, *[
        (ratios[n][1] if n in ratios else F.col(n)).alias(n) for n in names
    ])


def surge_by_fare_quantile(marts: Marts, parts: int = 4) -> DataFrame:
    """Weighted surge against the naive mean per fare quantile of completed trips."""
    trips = clean_trips(marts).where(F.col("is_completed") & F.col("total_fare").isNotNull())
    cents = trips.withColumn("_cents", (F.col("total_fare") * 100).cast("bigint"))
    cuts = quantile_cuts(cents, "_cents", parts)
    # The number of cuts below the fare; cuts are scalars, so no join takes place.
    quantile = F.lit(1)
    for i in range(1, parts):
        cut = cuts.select(f"cut_{i}").scalar()
        quantile = quantile + (F.col("_cents") > cut).cast("int")
    return (
        cents.withColumn("fare_quantile", quantile)
        .groupBy("fare_quantile")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            round_dp(safe_ratio(F.sum("total_fare"), F.count("total_fare")), 2).alias("avg_fare"),
            round_dp(
                safe_ratio(F.sum("surge_multiplier"), F.count("surge_multiplier")), 3
            ).alias("naive_avg_multiplier"),
            safe_pct(F.sum("surge_amount"), F.sum(_pre_surge())).alias("weighted_surge_pct"),
        )
        .orderBy("fare_quantile")
    )


def cancellations(marts: Marts) -> DataFrame:
    """Cancelled trips by reason category, party and stage reached, with share of all."""
    reasons = marts["dim_cancellation_reason"].select("cancellation_reason_id", "reason_category")
    grouped = (
        clean_trips(marts)
        .where("is_cancelled")
        .join(reasons, "cancellation_reason_id", "left")
        .groupBy("reason_category", "cancelled_by", "funnel_stage_reached")
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    # Categories x parties x stages: a few dozen rows.
    total = F.sum("trips").over(Window.partitionBy())
    return grouped.select("*", safe_pct(F.col("trips"), total).alias("pct_of_cancellations"))


def driver_productivity(marts: Marts) -> DataFrame:
    """Hours, trips and revenue per driver and local date, each fact aggregated first."""
    keys = ["driver_id", "date_id"]
    sessions = (
        marts[_SESSION]
        .groupBy("driver_id", F.col("online_date_id").alias("date_id"))
        .agg(F.count(F.lit(1)).alias("sessions"),
             (F.sum("session_duration_sec").cast("double") / 3600.0).alias("online_hours"))
    )
    trips = (
        clean_trips(marts)
        .where("is_completed")
        .groupBy("driver_id", F.col("request_date_id").alias("date_id"))
        .agg(F.count(F.lit(1)).alias("trips_completed"))
    )
    payments = (
        marts[_PAY]
        .where(~F.coalesce("is_quarantined", F.lit(False)))
        .groupBy("driver_id", F.col("paid_date_id").alias("date_id"))
        .agg(_money(F.sum("amount_charged")).alias("revenue_collected"))
    )
    grain = (
        sessions.select(*keys).unionByName(trips.select(*keys)).unionByName(payments.select(*keys))
        .where(F.col("driver_id").isNotNull() & F.col("date_id").isNotNull())
        .distinct()
    )
    joined = drill_across(grain, sessions, keys)
    joined = drill_across(joined, trips, keys)
    return drill_across(joined, payments, keys)
