"""Fares, distance, surge from demand and supply, anomaly and demand profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions import haversine_km, local_hour, safe_pct, safe_ratio, to_local
from kerbside.operators.sequence import sequence_events
from kerbside.sources.dimensions import city_zones

# ---- FIXED VALUES -------------------------------------------------------------
BOOKING_FEE = "25.00"
FREE_CANCELLATION_SECONDS = 60
CANCELLATION_FEES = {"MATCHED": "30.00", "DRIVER_ARRIVED": "50.00", "STARTED": "75.00"}

BUCKET_SECONDS = 600
MIN_DEMAND = 3
MIN_EFFECTIVE_SUPPLY = 2.0
SUPPLY_REACH = 1.35
TRIPS_PER_DRIVER_HOUR = 1.9
RATIO_THRESHOLD = 0.72
SENSITIVITY = 1.5
SMOOTHING_HUNDREDTHS = 35
FLOOR = "1.0"

MORNING_HOURS = (8, 9, 10)
EVENING_HOURS = (18, 19, 20)
# ---- end of fixed values ------------------------------------------------------

# Buckets that one chunk of a zone's timeline holds: a day.
CHUNK_BUCKETS = 144
FLOOR_TENTHS = 10
# Multipliers are folded in whole numbers, this many to a tenth: a hundredth of the smoothing
# weight times ten decimals of the raw multiplier.
TENTH = 10**11


def _cents(value: Column) -> Column:
    return F.round(value, 2).cast("decimal(12,2)")


def fare_breakdown(trips: DataFrame, cities: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Fare per trip from city and vehicle rates; every part is rounded before summing.

    `trips` needs trip_id, city_id, vehicle_type, distance_km, duration_sec,
    surge_multiplier, is_airport_trip and toll_amount. Trips without a positive distance and
    duration, or with a multiplier below one, have no fare and are left out.
    """
    rates = cities.select(
        "city_id", "currency_code", "per_km_rate", "per_min_rate", "tax_pct", "commission_pct",
        F.col("base_fare").alias("city_base_fare"), F.col("airport_fee").alias("city_airport_fee"),
    )
    factors = vehicles.select(
        F.col("vehicle_type_code").alias("vehicle_type"), "base_fare_multiplier",
        "per_km_multiplier",
    )
    priced = trips.where(
        (F.col("surge_multiplier") >= 1) & (F.col("distance_km") > 0) & (F.col("duration_sec") > 0)
    ).join(rates, "city_id").join(factors, "vehicle_type")
    hundred = F.lit(100).cast("decimal(3,0)")
    # Multiplying before dividing keeps the product exact.
    timed = F.col("duration_sec").cast("decimal(10,0)") * F.col("per_min_rate")
    parts = priced.withColumns({
        "base_fare": _cents(F.col("city_base_fare") * F.col("base_fare_multiplier")),
        "distance_fare": _cents(
            F.col("distance_km") * F.col("per_km_rate") * F.col("per_km_multiplier")
        ),
        "time_fare": _cents(timed / F.lit(60).cast("decimal(2,0)")),
        "airport_fee": _cents(
            F.when(F.col("is_airport_trip"), F.col("city_airport_fee")).otherwise(F.lit(0))
        ),
        "toll_amount": _cents(F.coalesce("toll_amount", F.lit(0))),
        "booking_fee": F.lit(BOOKING_FEE).cast("decimal(12,2)"),
    })
    pre_surge = F.col("base_fare") + F.col("distance_fare") + F.col("time_fare")
    surged = parts.withColumn("surge_amount", _cents(pre_surge * (F.col("surge_multiplier") - 1)))
    taxable = (
        pre_surge + F.col("surge_amount") + F.col("airport_fee") + F.col("toll_amount")
        + F.col("booking_fee")
    ).cast("decimal(14,2)")
    taxed = surged.withColumn("_taxable", taxable).withColumns({
        "tax_amount": _cents(F.col("_taxable") * F.col("tax_pct") / hundred),
        "platform_commission": _cents(F.col("_taxable") * F.col("commission_pct") / hundred),
    })
    return taxed.select(
        "trip_id", "base_fare", "distance_fare", "time_fare", "surge_multiplier", "surge_amount",
        "airport_fee", "toll_amount", "booking_fee", "tax_amount",
        (F.col("_taxable") + F.col("tax_amount")).cast("decimal(12,2)").alias("total_fare"),
        (F.col("_taxable") - F.col("platform_commission")).cast("decimal(12,2)").alias(
            "driver_payout"),
        "platform_commission", F.col("currency_code").alias("currency"),
    )


def cancellation_fee(stage: Column, applicable: Column, seconds: Column) -> Column:
    """Fee by the stage reached; free in the first minute or for reasons that carry none."""
    fee = F.lit("0.00")
    for name, amount in CANCELLATION_FEES.items():
        fee = F.when(stage == name, amount).otherwise(fee)
    free = ~applicable | (seconds < FREE_CANCELLATION_SECONDS)
    return F.when(free, "0.00").otherwise(fee).cast("decimal(12,2)")


def trip_distances(trips: DataFrame) -> DataFrame:
    """Straight-line distance of each request, against the estimated one."""
    direct = haversine_km(F.col("pickup_lat"), F.col("pickup_lon"), F.col("dropoff_lat"),
                          F.col("dropoff_lon"))
    return trips.where(F.col("requested_at").isNotNull()).select(
        "trip_id", direct.alias("direct_km"),
        safe_ratio(F.col("estimated_distance_km"), direct).alias("detour_factor"),
    )


# ---- surge ----------------------------------------------------------------------


def _bucket(ts: str) -> Column:
    return F.floor(F.unix_seconds(ts) / F.lit(BUCKET_SECONDS)).cast("bigint")


def demand_buckets(requests: DataFrame) -> DataFrame:
    """Requests per zone and ten-minute bucket. `requests` needs zone_id and requested_at."""
    return (
        requests.where(F.col("requested_at").isNotNull() & F.col("zone_id").isNotNull())
        .groupBy("zone_id", _bucket("requested_at").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("demand"))
    )


def supply_buckets(sessions: DataFrame, demand: DataFrame) -> DataFrame:
    """Demand with the sessions open in its zone at the start of its bucket.

    A session adds one from the first bucket starting at or after it goes online, and takes
    one off from the first starting at or after it goes offline. Open sessions never take it
    off. Running sums over these changes replace one row per session and bucket.
    """
    def first_start(ts: str) -> Column:
        return F.ceil(F.unix_micros(ts) / F.lit(BUCKET_SECONDS * 1e6)).cast("bigint")

    changes = (
        sessions.where(F.col("online_at").isNotNull()
                       & (F.col("offline_at").isNull()
                          | (F.col("offline_at") > F.col("online_at"))))
        .select("zone_id", F.explode(F.array(
            F.struct(first_start("online_at").alias("bucket"), F.lit(1).alias("change")),
            F.struct(first_start("offline_at").alias("bucket"), F.lit(-1).alias("change")),
        )).alias("c"))
        .select("zone_id", "c.bucket", "c.change")
        .where(F.col("bucket").isNotNull())
        .groupBy("zone_id", "bucket")
        .agg(F.sum("change").alias("change"))
    )
    both = changes.select("zone_id", "bucket", "change", F.lit(None).cast("bigint").alias("demand"))
    both = both.unionByName(demand.select("zone_id", "bucket", F.lit(0).cast("bigint").alias(
        "change"), "demand"))
    merged = both.groupBy("zone_id", "bucket").agg(
        F.sum("change").alias("change"), F.max("demand").alias("demand")
    )
    # One row per zone and bucket: the calendar bounds a zone's rows.
    order = Window.partitionBy("zone_id").orderBy("bucket")
    return merged.select(
        "zone_id", "bucket", "demand", F.sum("change").over(order).alias("supply")
    ).where(F.col("demand").isNotNull())


def weather_factors(requests: DataFrame, weather: DataFrame) -> DataFrame:
    """(zone_id, bucket, weather_factor): what the weather leaves of the supply in a bucket.

    A bucket has the weather that most of its requests report; of equally many, the one with the
    least id. `requests` needs zone_id, requested_at and weather_code.
    """
    rates = weather.select("weather_code", "weather_id", "supply_impact_factor")
    return (
        requests.where(F.col("requested_at").isNotNull() & F.col("zone_id").isNotNull())
        .groupBy("zone_id", _bucket("requested_at").alias("bucket"), "weather_code")
        .agg(F.count(F.lit(1)).alias("n")).join(rates, "weather_code")
        .groupBy("zone_id", "bucket")
        .agg(F.max_by(F.col("supply_impact_factor").cast("double"),
                      F.struct("n", -F.col("weather_id"))).alias("weather_factor"))
    )


def raw_surge(weather_factor: Column) -> Column:
    """Multiplier before smoothing: demand rate over the capacity rate of reachable drivers."""
    effective = F.greatest(
        F.col("supply").cast("double") * SUPPLY_REACH * weather_factor, F.lit(MIN_EFFECTIVE_SUPPLY)
    )
    ratio = F.col("demand").cast("double") * (3600.0 / BUCKET_SECONDS) / F.greatest(
        effective * TRIPS_PER_DRIVER_HOUR, F.lit(1.0)
    )
    return F.lit(1.0) + F.lit(SENSITIVITY) * F.greatest(F.lit(0.0), ratio - F.lit(RATIO_THRESHOLD))


def surge_grid(
    supplied: DataFrame, zones: DataFrame, cities: DataFrame, weather_factor: Column | None = None
) -> DataFrame:
    """Smoothed, capped multiplier per zone and demand-bearing bucket, in steps of 0.1.

    A bucket maps the multiplier before it to the one after it, and both lie on tenths between
    the floor and the cap. So it is a short list of states, and lists compose: each chunk of a
    zone's buckets is composed by itself, one list a chunk gives the state at which every chunk
    starts, and the chunks are then folded from there. A zone's timeline is so spread over
    tasks; only one list a chunk comes together, and the calendar bounds these.

    `weather_factor` is a column of `supplied`. A cap between tenths counts as the tenth below.
    """
    weather = F.lit(1.0) if weather_factor is None else weather_factor
    caps = zones.select("zone_id", "city_id", "is_surge_eligible").join(
        cities.select("city_id", "max_surge_multiplier"), "city_id"
    )
    chunk = F.floor(F.col("bucket") / F.lit(CHUNK_BUCKETS)).cast("bigint")
    rows = supplied.join(caps, "zone_id").select(
        "zone_id", "bucket", "demand", "supply", "is_surge_eligible", chunk.alias("chunk"),
        F.floor(F.col("max_surge_multiplier") * 10).cast("bigint").alias("top"),
        (F.col("demand") < MIN_DEMAND).alias("quiet"),
        raw_surge(weather).cast("decimal(20,10)").alias("raw"),
    )
    # Exact whole numbers: a tenth of a multiplier is TENTH.
    mapped = rows.withColumn("raw", (F.col("raw") * 10**10).cast("bigint")).select(
        "zone_id", "chunk", "bucket", "demand", "supply", "is_surge_eligible",
        _bucket_states().alias("states"))
    chunks = mapped.groupBy("zone_id", "chunk").agg(F.sort_array(F.collect_list(F.struct(
        "bucket", "states", "demand", "supply", "is_surge_eligible"))).alias("buckets"))
    composed = chunks.select("zone_id", "chunk", F.aggregate(
        F.slice("buckets", F.lit(2), F.size("buckets")), F.col("buckets")[0]["states"],
        lambda held, b: F.transform(held, lambda state: b["states"][state]),
    ).alias("states"))
    # The state before each chunk; 0 stands for none yet.
    begin = composed.groupBy("zone_id").agg(F.sort_array(F.collect_list(F.struct(
        "chunk", "states"))).alias("all")).select("zone_id", F.explode(F.aggregate(
            "all", F.struct(F.lit(0).alias("state"), F.array().cast(
                "array<struct<chunk:bigint,state:int>>").alias("starts")),
            lambda held, c: F.struct(
                c["states"][held["state"]].alias("state"),
                F.concat(held["starts"], F.array(F.struct(
                    c["chunk"].alias("chunk"), held["state"].alias("state")))).alias("starts")),
        )["starts"]).alias("start")).select("zone_id", "start.chunk", "start.state")
    steps = F.aggregate(
        "buckets", F.array(F.col("state")),
        lambda held, b: F.concat(held, F.array(b["states"][F.element_at(held, -1)])))
    grid = chunks.join(begin, ["zone_id", "chunk"]).select("zone_id", F.explode(F.arrays_zip(
        "buckets", F.slice(steps, F.lit(2), F.size("buckets")).alias("after"))).alias("r"))
    multiplier = ((F.col("r.after") + FLOOR_TENTHS - 1).cast("decimal(6,0)") / 10).cast(
        "decimal(4,1)")
    return grid.select(
        "zone_id", "r.buckets.bucket", "r.buckets.demand", "r.buckets.supply",
        F.when(F.col("r.buckets.is_surge_eligible"), multiplier)
        .otherwise(F.lit(FLOOR).cast("decimal(4,1)")).alias("multiplier"),
    )


def _bucket_states() -> Column:
    """The state after a bucket, for no state before it and then for every tenth up to the cap.

    State 1 is the floor. Half a tenth rounds to the even one.
    """
    low, high = F.lit(FLOOR_TENTHS * TENTH), F.col("top") * F.lit(TENTH)

    def rounded(aimed: Column) -> Column:
        aimed = F.least(F.greatest(aimed, low), high)
        whole = F.floor(aimed / F.lit(TENTH).cast("decimal(20,0)")).cast("bigint")
        rest = aimed - whole * F.lit(TENTH)
        up = (rest > TENTH // 2) | ((rest == TENTH // 2) & (whole % 2 == 1))
        return (whole + up.cast("int") - (FLOOR_TENTHS - 1)).cast("int")

    def after(before: Column) -> Column:
        # Tenths of before + SMOOTHING * (raw - before), in parts of a tenth.
        tenths = before + (FLOOR_TENTHS - 1)
        moved = F.col("raw") * F.lit(SMOOTHING_HUNDREDTHS) + tenths * F.lit(
            TENTH // 100 * (100 - SMOOTHING_HUNDREDTHS))
        return rounded(F.when(before == 0, F.col("raw") * 100).otherwise(moved))

    before = F.sequence(F.lit(0).cast("bigint"), F.col("top") - (FLOOR_TENTHS - 1))
    return F.transform(before, lambda b: F.when(F.col("quiet"), 1).otherwise(after(b)))


# ---- profiles -------------------------------------------------------------------


def anomaly_profile(landing: DataFrame) -> DataFrame:
    """Duplicates, late, skewed, out-of-order events and orphaned trips of a landed stream."""
    lateness = F.unix_millis("ingested_at") - F.unix_millis("event_timestamp")
    per_event = landing.groupBy("event_id", "correlation_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(lateness).alias("lateness_ms"),
        F.min("event_timestamp").alias("event_timestamp"),
        F.min("ingested_at").alias("ingested_at"),
        F.bool_or(F.col("event_type") == "RideRequested").alias("is_request"),
    )
    totals = per_event.agg(
        F.sum("copies").alias("total_events"),
        F.sum(F.col("copies") - 1).alias("duplicates"),
        F.count_if(F.col("lateness_ms") > 300_000).alias("late_arrivals"),
        F.count_if(F.col("lateness_ms") < 0).alias("clock_skewed"),
    )
    disordered = sequence_events(per_event).agg(F.count_if("is_out_of_order")).scalar()
    trips = per_event.groupBy("correlation_id").agg(F.bool_or("is_request").alias("has_request"))
    orphans = trips.agg(F.count_if(~F.col("has_request"))).scalar()
    counted = totals.withColumns({"out_of_order": disordered, "orphaned_trips": orphans})
    total = F.col("total_events")
    return counted.select(
        "*",
        safe_pct(F.col("duplicates"), total, 3).alias("duplicate_pct"),
        safe_pct(F.col("late_arrivals"), total, 3).alias("late_pct"),
        safe_pct(F.col("out_of_order"), total, 3).alias("out_of_order_pct"),
    )


def demand_curve(trips: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Share of requests per local hour, weekdays and weekends apart."""
    zones = city_zones(dims)
    local = trips.where(F.col("requested_at").isNotNull()).join(zones, "city_id").select(
        local_hour(F.col("requested_at"), F.col("city_timezone")).alias("local_hour"),
        (F.weekday(to_local(F.col("requested_at"), F.col("city_timezone"))) >= 5).alias(
            "is_weekend"),
    )
    hourly = local.groupBy("is_weekend", "local_hour").agg(F.count(F.lit(1)).alias("requests"))
    # 24 rows per kind of day.
    total = F.sum("requests").over(Window.partitionBy("is_weekend"))
    return hourly.select("*", safe_pct(F.col("requests"), total, 4).alias("share_pct"))


def commute_direction(trips: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Share of morning and evening requests going to each zone type."""
    zones = city_zones(dims)
    types = dims["dim_zone"].select(F.col("zone_id").alias("dropoff_zone_id"), "zone_type")
    hour = local_hour(F.col("requested_at"), F.col("city_timezone"))
    peak = F.when(hour.isin(*MORNING_HOURS), "MORNING").when(hour.isin(*EVENING_HOURS), "EVENING")
    grouped = (
        trips.where(F.col("requested_at").isNotNull())
        .join(zones, "city_id").join(types, "dropoff_zone_id")
        .select(peak.alias("peak"), "zone_type").where(F.col("peak").isNotNull())
        .groupBy("peak", "zone_type").agg(F.count(F.lit(1)).alias("requests"))
    )
    total = F.sum("requests").over(Window.partitionBy("peak"))
    return grouped.select("*", safe_pct(F.col("requests"), total, 4).alias("share_pct"))
