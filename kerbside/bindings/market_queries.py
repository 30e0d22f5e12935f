"""Fare, surge and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.bindings.marts import Marts
from kerbside.bindings.oracle import _local, query
from kerbside.bindings.queries import register
from kerbside.plans import marketplace as M


def _priced(m: Marts):
    return m.trips.where("completed_at IS NOT NULL AND requested_at IS NOT NULL").selectExpr(
        "trip_id", "city_id", "requested_vehicle_type AS vehicle_type", "distance_km",
        "duration_sec", "surge_multiplier",
        "coalesce(is_airport_pickup OR is_airport_dropoff, false) AS is_airport_trip",
        "toll_amount",
    )


# Whole-number cents and exact decimals throughout.
_FARE = f"""
  SELECT trip_id, cast(b AS double) AS base_fare, cast(d AS double) AS distance_fare,
    cast(t AS double) AS time_fare, cast(surge_multiplier AS double) AS surge_multiplier,
    cast(s AS double) AS surge_amount, cast(a AS double) AS airport_fee,
    cast(toll AS double) AS toll_amount, cast(25 AS double) AS booking_fee,
    cast(tax AS double) AS tax_amount, cast(taxable + tax AS double) AS total_fare,
    cast(taxable - comm AS double) AS driver_payout, cast(comm AS double) AS platform_commission,
    currency_code AS currency
  FROM (SELECT *, cast(round(taxable * tax_pct * 0.01, 2) AS decimal(14,2)) AS tax,
          cast(round(taxable * commission_pct * 0.01, 2) AS decimal(14,2)) AS comm
    FROM (SELECT *, cast(b + d + t + s + a + toll + 25 AS decimal(14,2)) AS taxable
      FROM (SELECT *, cast(round((b + d + t) * (surge_multiplier - 1), 2) AS decimal(14,2)) AS s
        FROM (SELECT trip_id, surge_multiplier, tax_pct, commission_pct, currency_code,
            cast(round(c.base_fare * base_fare_multiplier, 2) AS decimal(14,2)) AS b,
            cast(round(distance_km * per_km_rate * per_km_multiplier, 2) AS decimal(14,2)) AS d,
            cast((2 * duration_sec * cast(per_min_rate * 100 AS bigint) + 60) // 120 * 0.01
                 AS decimal(14,2)) AS t,
            cast(CASE WHEN is_airport_pickup OR is_airport_dropoff THEN c.airport_fee ELSE 0 END
                 AS decimal(14,2)) AS a, cast(coalesce(toll_amount, 0) AS decimal(14,2)) AS toll
          FROM trips JOIN dim_city c USING (city_id)
          JOIN dim_vehicle_type v ON v.vehicle_type_code = requested_vehicle_type
          WHERE completed_at IS NOT NULL AND requested_at IS NOT NULL AND surge_multiplier >= 1
            AND distance_km > 0 AND duration_sec > 0))))"""
register("fare_breakdown", query(_FARE, "trips", "dim_city", "dim_vehicle_type"))(
    lambda m: M.fare_breakdown(_priced(m), m.dims["dim_city"], m.dims["dim_vehicle_type"])
)

register(
    "cancellation_fees",
    query("SELECT trip_id, CASE WHEN NOT coalesce(is_fee_applicable, false) OR "
          "seconds_since_request < 60 THEN 0.0 ELSE CASE cancelled_at_status WHEN 'MATCHED' THEN "
          "30.0 WHEN 'DRIVER_ARRIVED' THEN 50.0 WHEN 'STARTED' THEN 75.0 ELSE 0.0 END END::double "
          "AS fee FROM can LEFT JOIN dim_cancellation_reason USING (cancellation_reason_code)",
          "can", "dim_cancellation_reason"),
)(lambda m: m.typed("RideCancelled").join(
    m.dims["dim_cancellation_reason"].select("cancellation_reason_code", "is_fee_applicable"),
    "cancellation_reason_code", "left",
).select("trip_id", M.cancellation_fee(
    F.col("cancelled_at_status"), F.coalesce("is_fee_applicable", F.lit(False)),
    F.col("seconds_since_request"),
).alias("fee")))

register(
    "trip_distances",
    query("SELECT trip_id, round(2 * 6371.0088 * asin(sqrt(pow(sin(radians(y2 - y1) / 2), 2) + "
          "cos(radians(y1)) * cos(radians(y2)) * pow(sin(radians(x2 - x1) / 2), 2))), 6) AS km "
          "FROM (SELECT trip_id, cast(pickup_lat AS double) AS y1, cast(pickup_lon AS double) AS x1, "
          "cast(dropoff_lat AS double) AS y2, cast(dropoff_lon AS double) AS x2 FROM req)", "req"),
)(lambda m: M.trip_distances(m.trips).select("trip_id", F.round("direct_km", 6).alias("km")))



def _demand(m: Marts, trips=None):
    return M.demand_buckets((m.trips if trips is None else trips).selectExpr(
        "pickup_zone_id AS zone_id", "requested_at"))


def _sessions(m: Marts, sessions=None):
    return (m.sessions if sessions is None else sessions).selectExpr(
        "online_zone_id AS zone_id", "online_at", "offline_at")


def _supply_once(m: Marts):
    """`supply_buckets` in one plan. What the trips of a session add up to is not read, so trips
    are assembled for the demand only."""
    return M.supply_buckets(_sessions(m, m.once("sessions", "trips")),
                            _demand(m, m.once("trips")))


_DEMAND = ("SELECT pickup_zone_id AS zone_id, cast(floor(epoch(requested_at) / 600) AS bigint) "
           "AS bucket, count(*) AS demand FROM trips WHERE requested_at IS NOT NULL AND "
           "pickup_zone_id IS NOT NULL GROUP BY 1, 2")
_SUPPLY = ("SELECT d.zone_id, d.bucket, any_value(d.demand) AS demand, count(s.online) AS supply "
           f"FROM ({_DEMAND}) d LEFT JOIN (SELECT online_zone_id AS zone_id, epoch(online_at) AS "
           "online, epoch(offline_at) AS offline FROM ses) s ON s.zone_id = d.zone_id AND "
           "s.online <= d.bucket * 600 AND (s.offline IS NULL OR d.bucket * 600 < s.offline) "
           "GROUP BY 1, 2")
register("demand_buckets", query(_DEMAND, "trips"))(_demand)
register("supply_buckets", query(_SUPPLY, "trips", "ses"))(
    _supply_once
)
_RAW = ("1.0 + 1.5 * greatest(0.0, demand * 6.0 / greatest(greatest(supply * 1.35, 2.0) * 1.9, 1.0) "
        "- 0.72)")
# The recurrence, bucket by bucket of a zone; t is the multiplier in tenths, aimed at as x.
_GRID = f"""
  SELECT zone_id, bucket, demand, supply,
    if(is_surge_eligible, cast(t AS double) / 10, 1.0::double) AS multiplier
  FROM (
    WITH RECURSIVE steps AS (
      SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY bucket) AS n,
        cast({_RAW} AS decimal(20,10)) AS raw, cast(max_surge_multiplier * 10 AS int) AS top
      FROM ({_SUPPLY}) JOIN dim_zone USING (zone_id) JOIN dim_city USING (city_id)),
    grid AS (
      SELECT zone_id, n, bucket, demand, supply, is_surge_eligible,
        {{first}} AS t FROM (SELECT *, least(greatest(raw * 10, 10), top) AS x FROM steps
                           WHERE n = 1)
      UNION ALL
      SELECT zone_id, n, bucket, demand, supply, is_surge_eligible, {{first}} AS t
      FROM (SELECT s.*, least(greatest(
              cast(g.t + 0.35 * (s.raw * 10 - g.t) AS decimal(30,12)), 10), s.top) AS x
            FROM grid g JOIN steps s ON s.zone_id = g.zone_id AND s.n = g.n + 1))
    SELECT * FROM grid)""".replace("{first}", """
        cast(CASE WHEN demand < 3 THEN 10 WHEN x - floor(x) = 0.5 THEN floor(x) + floor(x) % 2
             ELSE floor(x + 0.5) END AS int)""")
register("surge_grid", query(_GRID, "trips", "ses", "dim_zone", "dim_city"))(
    lambda m: M.surge_grid(M.supply_buckets(_sessions(m), _demand(m)), m.dims["dim_zone"],
                           m.dims["dim_city"])
)
# The same with the weather that most requests of a bucket report.
_WEATHER = ("SELECT pickup_zone_id AS zone_id, cast(floor(epoch(requested_at) / 600) AS bigint) AS "
            "bucket, arg_max(supply_impact_factor, n * 100 - weather_id) AS wf FROM (SELECT *, "
            "count(*) OVER (PARTITION BY pickup_zone_id, floor(epoch(requested_at) / 600), "
            "request_weather_code) AS n FROM trips WHERE requested_at IS NOT NULL) JOIN "
            "dim_weather ON weather_code = request_weather_code GROUP BY 1, 2")
_UNDER_WEATHER = (f"SELECT s.*, coalesce(wf, 1) AS wf FROM ({_SUPPLY}) s "
                  f"LEFT JOIN ({_WEATHER}) USING (zone_id, bucket)")


def surge_grid_under_weather(m: Marts):
    requests = m.trips.selectExpr("pickup_zone_id AS zone_id", "requested_at",
                                  "request_weather_code AS weather_code")
    supplied = M.supply_buckets(_sessions(m), _demand(m)).join(
        M.weather_factors(requests, m.dims["dim_weather"]), ["zone_id", "bucket"], "left")
    return M.surge_grid(supplied, m.dims["dim_zone"], m.dims["dim_city"],
                        F.coalesce("weather_factor", F.lit(1.0)))


register(
    "surge_grid_under_weather",
    query(_GRID.replace(_SUPPLY, _UNDER_WEATHER).replace("supply * 1.35", "supply * 1.35 * wf"),
          "trips", "ses", "dim_zone", "dim_city", "dim_weather"),
)(surge_grid_under_weather)
register(
    "raw_surge",
    query(f"SELECT zone_id, bucket, round({_RAW}, 6) AS raw FROM ({_SUPPLY})", "trips", "ses"),
)(lambda m: _supply_once(m).select(
    "zone_id", "bucket", F.round(M.raw_surge(F.lit(1.0)), 6).alias("raw")
))

register(
    "anomaly_profile",
    query("""
      SELECT total_events, duplicates, late_arrivals, clock_skewed, out_of_order, orphaned_trips,
        round(100.0 * duplicates / total_events, 3) AS duplicate_pct,
        round(100.0 * late_arrivals / total_events, 3) AS late_pct,
        round(100.0 * out_of_order / total_events, 3) AS out_of_order_pct
      FROM (SELECT cast(sum(n) AS bigint) AS total_events, cast(sum(n - 1) AS bigint) AS duplicates,
              count(*) FILTER (late > 300) AS late_arrivals, count(*) FILTER (late < 0)
              AS clock_skewed, count(*) FILTER (r1 != r2) AS out_of_order,
              (SELECT count(*) FROM (SELECT correlation_id FROM trip_landing GROUP BY 1 HAVING
               NOT bool_or(event_type = 'RideRequested'))) AS orphaned_trips
            FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY e, event_id) AS r1,
                    row_number() OVER (PARTITION BY c ORDER BY i, event_id) AS r2
                  FROM (SELECT event_id, correlation_id AS c, count(*) AS n,
                          min(date_diff('second', event_timestamp, ingested_at)) AS late,
                          min(event_timestamp) AS e, min(ingested_at) AS i
                        FROM trip_landing GROUP BY 1, 2)))"""),
)(lambda m: M.anomaly_profile(m.landing))

_AT = _local("requested_at", "c.timezone")
register(
    "demand_curve",
    query(f"SELECT is_weekend, local_hour, count(*) AS requests, round(100.0 * count(*) / "
          f"sum(count(*)) OVER (PARTITION BY is_weekend), 4) AS share_pct FROM (SELECT isodow({_AT}) "
          f">= 6 AS is_weekend, hour({_AT}) AS local_hour FROM trips JOIN dim_city c USING (city_id) "
          "WHERE requested_at IS NOT NULL) GROUP BY 1, 2", "trips", "dim_city"),
)(lambda m: M.demand_curve(m.trips, m.dims))
register(
    "commute_direction",
    query(f"SELECT peak, zone_type, count(*) AS requests, round(100.0 * count(*) / sum(count(*)) "
          f"OVER (PARTITION BY peak), 4) AS share_pct FROM (SELECT CASE WHEN hour({_AT}) IN (8, 9, "
          f"10) THEN 'MORNING' WHEN hour({_AT}) IN (18, 19, 20) THEN 'EVENING' END AS peak, "
          "z.zone_type FROM trips JOIN dim_city c USING (city_id) JOIN dim_zone z ON z.zone_id = "
          "dropoff_zone_id) WHERE peak IS NOT NULL GROUP BY 1, 2", "trips", "dim_city", "dim_zone"),
)(lambda m: M.commute_direction(m.trips, m.dims))
