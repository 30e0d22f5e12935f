"""Landing rows derived from the driver's order tables.

One order becomes one trip; suppliers drive, customers ride. Everything is whole-number
arithmetic on keys in SQL that Spark and DuckDB read alike, so both engines start from the
same landing table. Broken, late, repeated and orphaned events are derived too.
"""

from __future__ import annotations

ZONES = (87, 91, 95, 99, 104, 118, 124, 131, 137, 142, 205, 212, 219, 226, 233, 240, 260, 318,
         324, 331, 338, 412, 415, 421, 434, 512)
VEHICLES = ("ECONOMY", "PREMIUM", "XL", "POOL", "AUTO", "BIKE")
WEATHER = ("CLEAR", "CLOUDY", "RAIN_LIGHT", "RAIN_HEAVY", "THUNDERSTORM", "FOG", "EXTREME_HEAT")
TRAFFIC = ("FREE_FLOW", "LIGHT", "MODERATE", "HEAVY", "GRIDLOCK")
METHODS = ("CASH", "CARD", "UPI", "WALLET", "CORPORATE", "NETBANKING")
REASONS = ("RIDER_CHANGED_MIND", "DRIVER_ETA_TOO_LONG", "DRIVER_TOO_FAR", "NO_DRIVER_AVAILABLE",
           "SYSTEM_ERROR", "PRICE_TOO_HIGH", "A_NEW_REASON")
PARTIES = ("RIDER", "DRIVER", "SYSTEM")


def pick(index: str, values: tuple) -> str:
    """values[index % n] as a CASE."""
    arms = " ".join(
        f"WHEN {i} THEN {v if isinstance(v, int) else chr(39) + v + chr(39)}"
        for i, v in enumerate(values)
    )
    return f"CASE cast(({index}) % {len(values)} as int) {arms} END"


def money(cents: str) -> str:
    """Whole cents as decimal text."""
    return (
        f"concat(cast(cast((({cents}) - ({cents}) % 100) / 100 as bigint) as string), '.', "
        f"lpad(cast(({cents}) % 100 as string), 2, '0'))"
    )


def iso(ts: str) -> str:
    return f"concat(replace(cast({ts} as string), ' ', 'T'), 'Z')"


def after(ts: str, seconds: str) -> str:
    return f"{ts} + ({seconds}) * interval '1' second"


def json_object(fields: dict[str, str]) -> str:
    """A JSON object; each value is SQL giving JSON text."""
    parts, sep = [], "{"
    for name, sql in fields.items():
        parts.append(f"'{sep}\"{name}\":'")
        parts.append(sql)
        sep = ","
    return f"concat({', '.join(parts)}, '}}')"


def quoted(sql: str) -> str:
    return f"concat('\"', {sql}, '\"')"


def nullable(sql: str) -> str:
    return f"CASE WHEN {sql} IS NULL THEN 'null' ELSE concat('\"', {sql}, '\"') END"


def number(sql: str) -> str:
    return f"cast({sql} as string)"


def boolean(sql: str) -> str:
    return f"CASE WHEN {sql} THEN 'true' ELSE 'false' END"


def _stage_payloads() -> dict[int, str]:
    ids = {"trip_id": quoted("trip_id"), "rider_id": quoted("rider_id")}
    driver = {"driver_id": nullable("driver_id")}
    city = {"city_id": number("city_id")}
    return {
        1: json_object({
            **ids, **city, "requested_at": quoted(iso("requested_at")),
            "pickup_lat": money("1290 + k % 20"), "pickup_lon": money("7755 + k % 15"),
            "pickup_zone_id": number("pickup_zone"),
            "dropoff_lat": money("1290 + k % 13"), "dropoff_lon": money("7755 + k % 17"),
            "dropoff_zone_id": number("dropoff_zone"),
            "vehicle_type": quoted("vehicle"),
            "estimated_fare": f"CASE WHEN k % 557 = 1 THEN '\"abc\"' ELSE {money('est_c')} END",
            "estimated_distance_km": money("est_km_c"),
            "estimated_duration_sec": number("300 + k % 900"),
            "surge_multiplier": money("surge_c"),
            "payment_method": quoted("method"), "customer_tier": quoted("tier"),
            "is_airport_pickup": boolean("airport"), "is_airport_dropoff": boolean("k % 45 = 0"),
            "weather_code": quoted("weather"), "traffic_level": quoted("traffic"),
            "promo_code": "CASE WHEN k % 9 = 0 THEN '\"SAVE10\"' WHEN k % 9 = 1 THEN '\"\"' "
                          "ELSE 'null' END",
            "device_platform": f"concat('\"', {pick('k', ('IOS', 'ANDROID', 'WEB'))}, '\"')",
            "app_version": "'\"4.1.0\"'",
        }),
        2: json_object({
            **ids, **driver, **city, "accepted_at": quoted(iso("accepted_at")),
            "driver_lat": money("1291 + k % 20"), "driver_lon": money("7756 + k % 15"),
            "driver_zone_id": number("dropoff_zone"), "vehicle_id": nullable("concat('v-', driver_id)"),
            "vehicle_type": quoted("vehicle"), "matching_duration_sec": number("match_sec"),
            "eta_to_pickup_sec": number("eta"), "distance_to_pickup_km": money("50 + k % 700"),
            "driver_rating_at_accept": money("300 + k % 200"),
            "dispatch_attempt_number": number("1 + k % 3"),
        }),
        3: json_object({
            **ids, **driver, **city, "arrived_at": quoted(iso("arrived_at")),
            "driver_lat": money("1290 + k % 20"), "driver_lon": money("7755 + k % 15"),
            "actual_pickup_duration_sec": number("pickup_sec"),
            "arrival_delay_sec": number("pickup_sec - eta"),
            "is_late_arrival": boolean("pickup_sec - eta > 180"),
        }),
        4: json_object({
            **ids, **driver, **city, "started_at": quoted(iso("started_at")),
            "actual_pickup_lat": money("1290 + k % 20"),
            "actual_pickup_lon": money("7755 + k % 15"),
            "rider_wait_duration_sec": number("wait_sec"), "pickup_zone_id": number("pickup_zone"),
        }),
        5: json_object({
            **ids, **driver, **city, "completed_at": quoted(iso("completed_at")),
            "dropoff_lat": money("1290 + k % 13"), "dropoff_lon": money("7755 + k % 17"),
            "dropoff_zone_id": number("dropoff_zone"), "distance_km": money("km_c"),
            "duration_sec": number("dur"),
            "base_fare": f"CASE WHEN k % 1301 = 5 THEN '-1.00' ELSE {money('base_c')} END",
            "distance_fare": money("dist_c"), "time_fare": money("time_c"),
            "surge_multiplier": money("surge_c + CASE WHEN k % 701 = 3 THEN 10 ELSE 0 END"),
            "surge_amount": money("surge_amt_c"), "airport_fee": money("airport_c"),
            "toll_amount": money("toll_c"), "booking_fee": money("2500"),
            "tax_amount": money("tax_c"), "total_fare": money("total_c"),
            "driver_payout": money(
                "taxable_c - comm_c + CASE WHEN k % 907 = 4 THEN 5 ELSE 0 END"),
            "platform_commission": money("comm_c"), "currency": "'\"INR\"'",
            "traffic_level": quoted("traffic2"), "weather_code": quoted("weather"),
            "payment_method": quoted("method"),
        }),
        6: json_object({
            **ids,
            "driver_id": "CASE WHEN acc = 1 THEN concat('\"', driver_id, '\"') ELSE 'null' END",
            **city, "cancelled_at": quoted(iso("cancelled_at")),
            "cancelled_by": f"concat('\"', {pick('k', PARTIES)}, '\"')",
            "cancellation_reason_code": f"concat('\"', {pick('k', REASONS)}, '\"')",
            "cancelled_at_status": "CASE WHEN acc = 0 AND k % 307 <> 1 THEN '\"REQUESTED\"' "
                                   "WHEN k % 7 = 1 THEN '\"DRIVER_ARRIVED\"' "
                                   "WHEN k % 7 = 2 THEN '\"STARTED\"' ELSE '\"MATCHED\"' END",
            "seconds_since_request": number("cancel_sec"),
            "cancellation_fee": "CASE WHEN acc = 1 THEN '30.00' ELSE '0' END",
            "is_fee_charged": boolean("acc = 1"), "is_driver_fault": boolean("k % 5 = 1"),
            "currency": "'\"INR\"'",
        }),
        7: json_object({
            **ids, **driver, **city, "payment_id": quoted("concat('pay-', cast(k as string))"),
            "paid_at": quoted(iso("paid_at")), "payment_method": quoted("method"),
            "payment_status": "'\"SUCCEEDED\"'", "trip_fare": money("total_c"),
            "tip_amount": money("tip_c"), "discount_amount": money("disc_c"),
            "amount_charged": money(
                "total_c + tip_c - disc_c + CASE WHEN k % 659 = 2 THEN 3 ELSE 0 END"),
            "currency": "'\"INR\"'",
            "promo_code": "CASE WHEN k % 9 = 0 THEN '\"SAVE10\"' ELSE 'null' END",
            "attempt_number": number("CASE WHEN k % 25 = 0 THEN 2 ELSE 1 END"),
            "previous_attempt_failure_reason":
                "CASE WHEN k % 25 = 0 AND k % 100 <> 0 THEN '\"DECLINED\"' ELSE 'null' END",
            "gateway_reference": quoted("concat('gw-ref-', cast(k as string))"),
        }),
    }


TRIP_CTES = """
li AS (
  SELECT l_orderkey, min(l_suppkey) AS supp, cast(sum(cast(l_quantity as bigint)) as bigint) AS qty
  FROM {lineitem} GROUP BY l_orderkey
),
t0 AS (
  SELECT o.o_orderkey AS k, cast(o.o_custkey as bigint) AS cust, li.supp AS supp,
         coalesce(li.qty, 5) AS qty, cast(coalesce(c.c_nationkey, 0) as bigint) AS nk,
         substr(o.o_orderpriority, 1, 1) AS pr,
         {requested} AS requested_at,
         CASE WHEN li.supp IS NOT NULL AND o.o_orderkey % 13 <> 0 THEN 1 ELSE 0 END AS acc
  FROM {orders} o
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey
  LEFT JOIN {customer} c ON c.c_custkey = o.o_custkey
),
t1 AS (
  SELECT *, 20 + k % 200 AS match_sec, 200 + (k * 3) % 900 AS eta,
         200 + (k * 3) % 900 + (k * 5) % 400 - 150 AS pickup_sec, k % 240 AS wait_sec,
         300 + qty * 20 + k % 300 AS dur, 700 + qty * 10 AS km_c, 650 + qty * 11 AS est_km_c,
         5000 + nk * 100 AS base_c, 700 + qty * 180 AS dist_c,
         CASE WHEN k % 4 = 0 THEN (10 + cast((k - k % 4) / 4 as bigint) % 12) * 10 ELSE 100 END
           AS surge_c,
         k % 15 = 0 AS airport,
         CASE WHEN k % 15 = 0 OR k % 1009 = 2 THEN 15000 ELSE 0 END AS airport_c,
         CASE WHEN k % 16 = 1 THEN 3000 + (k % 90) * 100 ELSE 0 END AS toll_c,
         (k % 10) * 100 AS tip_c, CASE WHEN k % 9 = 0 THEN 500 ELSE 0 END AS disc_c,
         CASE WHEN acc = 0 THEN 30 + k % 100 ELSE 70 + k % 200 END AS cancel_sec
  FROM t0
),
t2 AS (
  SELECT *, dur * 3 AS time_c FROM t1
),
t3 AS (
  SELECT *, cast(((base_c + dist_c + time_c) * (surge_c - 100)
                  - ((base_c + dist_c + time_c) * (surge_c - 100)) % 100) / 100 as bigint)
            AS surge_amt_c
  FROM t2
),
t4 AS (
  SELECT *, base_c + dist_c + time_c + surge_amt_c + airport_c + toll_c + 2500 AS taxable_c FROM t3
),
t5 AS (
  SELECT *, cast((taxable_c * 5 - (taxable_c * 5) % 100) / 100 as bigint) AS tax_c,
         cast((taxable_c - taxable_c % 5) / 5 as bigint) AS comm_c FROM t4
),
t6 AS (
  SELECT *, taxable_c + tax_c
            + CASE WHEN k % 809 = 1 THEN 2 WHEN k % 809 = 2 THEN 1 ELSE 0 END AS total_c,
         {accepted} AS accepted_at
  FROM t5
),
t7 AS (
  SELECT *, total_c - 700 + (k % 14) * 100 AS est_c, {arrived} AS arrived_at FROM t6
),
t8 AS (
  SELECT *, {started} AS started_at FROM t7
),
t9 AS (
  SELECT *, {completed} AS completed_at FROM t8
),
trip AS (
  SELECT *, {paid} AS paid_at, {cancelled} AS cancelled_at,
         concat('trip-', cast(k as string)) AS trip_id,
         concat('rider-', cast(cust as string)) AS rider_id,
         concat('driver-', cast(supp as string)) AS driver_id,
         CASE WHEN k % 601 = 0 THEN 77 ELSE 1 + k % 6 END AS city_id,
         CASE WHEN k % 503 = 0 THEN 999 ELSE {zone_a} END AS pickup_zone,
         {zone_b} AS dropoff_zone,
         CASE WHEN k % 53 = 1 THEN 'HOVERCRAFT' ELSE {vehicle} END AS vehicle,
         {weather} AS weather, {traffic} AS traffic, {traffic2} AS traffic2, {method} AS method,
         CASE pr WHEN '1' THEN 'PLATINUM' WHEN '2' THEN 'GOLD' WHEN '3' THEN 'SILVER'
                 ELSE 'BASIC' END AS tier
  FROM t9
),
staged AS (
  SELECT *, {explode_stage} AS s FROM trip
),
present AS (
  SELECT *, cast(CASE WHEN s > 7 THEN s - 7 ELSE s END as bigint) AS st,
         CASE WHEN s > 7 THEN 1 ELSE 0 END AS copy
  FROM staged
  WHERE (s <= 7 OR k % 50 = 0)
),
live AS (
  SELECT *, {stage_time} AS event_ts
  FROM present
  WHERE CASE cast(st as int)
        WHEN 1 THEN k % 97 <> 0
        WHEN 2 THEN acc = 1
        WHEN 3 THEN acc = 1 AND k % 17 <> 3
        WHEN 4 THEN acc = 1 AND k % 19 <> 4 AND (k % 11 <> 0 OR k % 121 = 0)
        WHEN 5 THEN acc = 1 AND (k % 19 <> 4 OR k % 211 = 5) AND (k % 11 <> 0 OR k % 121 = 0)
        WHEN 6 THEN (acc = 0 AND k % 3 <> 0) OR (acc = 1 AND k % 11 = 0)
        ELSE acc = 1 AND ((k % 19 <> 4 AND k % 11 <> 0 AND k % 23 <> 0) OR k % 307 = 7)
        END
),
timed AS (
  SELECT *, {ingested} AS in_ts FROM live
),
trip_landing AS (
  SELECT concat('e-', cast(k as string), '-', cast(st as string)) AS event_id,
         {event_type} AS event_type, '1.0.0' AS event_version,
         event_ts AS event_timestamp, in_ts AS ingested_at,
         trip_id AS partition_key, trip_id AS correlation_id,
         CASE WHEN st > 1 AND NOT (st = 6 AND acc = 0)
              THEN concat('e-', cast(k as string), '-', cast(st - 1 as string))
              WHEN st = 6 THEN concat('e-', cast(k as string), '-1') END AS causation_id,
         'trip-service' AS producer_service, '2.3.1' AS producer_version,
         CASE WHEN k % 199 = 10 THEN 'staging' ELSE 'local' END AS environment,
         {payload} AS payload_json,
         'trips.events.v1' AS kafka_topic, cast(k % 12 as int) AS kafka_partition,
         cast(k * 20 + s as bigint) AS kafka_offset,
         CASE WHEN k % 29 = 0 THEN NULL ELSE {landed} END AS landed_at
  FROM timed
)
"""

PRESENCE_CTES = """
sess AS (
  SELECT supp, year(requested_at) * 12 + month(requested_at) AS ym,
         min(accepted_at) AS first_at, count(*) AS n
  FROM trip WHERE acc = 1
  GROUP BY supp, year(requested_at) * 12 + month(requested_at)
),
sess1 AS (
  SELECT *, supp * 7 + ym AS h, {online} AS online_at, {offline} AS offline_at,
         concat('driver-', cast(supp as string)) AS driver_id,
         concat('s-', cast(supp as string), '-', cast(ym as string)) AS session_id
  FROM sess
),
sess2 AS (
  SELECT *, {explode_session} AS s FROM sess1
),
sess3 AS (
  SELECT *, CASE WHEN s > 2 THEN s - 2 ELSE s END AS st,
         {session_time} AS event_ts
  FROM sess2
  WHERE (s <= 2 OR h % 25 = 0)
    AND CASE WHEN s % 2 = 1 THEN h % 37 <> 5 ELSE h % 11 <> 0 END
),
presence_landing AS (
  SELECT concat('p-', cast(supp as string), '-', cast(ym as string), '-', cast(st as string))
           AS event_id,
         CASE WHEN st = 1 THEN 'DriverOnline' ELSE 'DriverOffline' END AS event_type,
         '1.0.0' AS event_version, event_ts AS event_timestamp, {session_ingested} AS ingested_at,
         driver_id AS partition_key, session_id AS correlation_id,
         CASE WHEN st = 2 THEN concat('p-', cast(supp as string), '-', cast(ym as string), '-1')
              END AS causation_id,
         'driver-service' AS producer_service, '1.9.0' AS producer_version,
         CASE WHEN h % 199 = 10 THEN 'staging' ELSE 'local' END AS environment,
         CASE WHEN st = 1 THEN {online_payload} ELSE {offline_payload} END AS payload_json,
         'drivers.presence.v1' AS kafka_topic, cast(supp % 6 as int) AS kafka_partition,
         cast(supp * 10000 + ym % 1000 * 10 + s as bigint) AS kafka_offset,
         {session_landed} AS landed_at
  FROM sess3
)
"""


def landing_ctes(dialect: str, tables: dict[str, str] | None = None) -> str:
    """CTEs ending in trip_landing and presence_landing, for "spark" or "duckdb"."""
    tables = tables or {t: t for t in ("orders", "lineitem", "customer")}
    unnest = {
        # Only keys with copies get the numbers above half, which a filter drops for the others.
        "spark": lambda n, copied: f"explode(sequence(1, CASE WHEN {copied} THEN {n} "
                                   f"ELSE {n // 2} END))",
        "duckdb": lambda n, copied: f"unnest(range(1, {n + 1}))",
    }[dialect]
    payloads = _stage_payloads()
    types = ("RideRequested", "RideAccepted", "DriverArrived", "RideStarted", "RideCompleted",
             "RideCancelled", "PaymentCompleted")
    times = ("requested_at", "accepted_at", "arrived_at", "started_at", "completed_at",
             "cancelled_at", "paid_at")

    def per_stage(arms) -> str:
        return "CASE cast(st as int) " + " ".join(
            f"WHEN {i} THEN {sql}" for i, sql in enumerate(arms, 1)
        ) + " END"

    session_ids = {"driver_id": quoted("driver_id"), "session_id": quoted("session_id"),
                   "city_id": number("1 + supp % 6"), "online_at": quoted(iso("online_at"))}
    where = {"driver_lat": money("1290 + h % 20"), "driver_lon": money("7755 + h % 15")}
    zone = pick("supp * 5 + ym * 3", ZONES)
    zone2 = pick("supp * 5 + ym * 3 + (h % 3)", ZONES)
    subst = {
        **tables,
        "requested": after("o.o_orderdate", "(o.o_orderkey * 7919) % 86400"),
        "accepted": after("requested_at", "match_sec"),
        "arrived": after("accepted_at", "pickup_sec"),
        "started": after("arrived_at", "wait_sec"),
        "completed": after("started_at", "dur"),
        "paid": after("completed_at", "CASE WHEN k % 401 = 9 THEN -60 ELSE 5 + k % 50 END"),
        "cancelled": after("requested_at", "cancel_sec"),
        "zone_a": pick("nk * 7 + k", ZONES),
        "zone_b": pick("k * 11 + 3", ZONES),
        "vehicle": pick("k", VEHICLES),
        "weather": pick("k + nk", WEATHER),
        "traffic": pick("k", TRAFFIC),
        "traffic2": pick("k + 2", TRAFFIC),
        "method": pick("k", METHODS),
        "explode_stage": unnest(14, "k % 50 = 0"),
        "stage_time": per_stage(times),
        "ingested": after("event_ts", "CASE WHEN (k * 7 + st) % 20 = 0 THEN 400 + k % 5000 "
                                      "WHEN (k + st) % 41 = 0 THEN -120 ELSE 2 + k % 7 END "
                                      "+ copy * 3600"),
        "landed": after("in_ts", "30"),
        "event_type": per_stage([f"'{t}'" for t in types]),
        "payload": per_stage([payloads[i] for i in range(1, 8)]),
        "online": after("first_at", "-600"),
        "offline": after("first_at", "864000"),
        "explode_session": unnest(4, "h % 25 = 0"),
        "session_time": "CASE WHEN s % 2 = 1 THEN online_at ELSE offline_at END",
        "session_ingested": after("event_ts", "3 + CASE WHEN s > 2 THEN 1800 ELSE 0 END"),
        "session_landed": after("event_ts", "60 + CASE WHEN s > 2 THEN 1800 ELSE 0 END"),
        "online_payload": json_object({
            **session_ids, **where, "zone_id": number(zone),
            "vehicle_id": quoted("concat('v-', driver_id)"),
            "vehicle_type": f"concat('\"', {pick('supp', VEHICLES)}, '\"')",
            "driver_status": "CASE WHEN h % 90 = 7 THEN '\"NAPPING\"' ELSE '\"AVAILABLE\"' END",
            "device_platform": "'\"ANDROID\"'", "app_version": "'\"4.1.0\"'",
        }),
        "offline_payload": json_object({
            **session_ids, "offline_at": quoted(iso("offline_at")), **where,
            "zone_id": number(zone2), "session_duration_sec": number("864600"),
            "trips_completed_in_session": number("n"), "offline_reason": "'\"SHIFT_END\"'",
        }),
    }
    text = TRIP_CTES.strip() + ",\n" + PRESENCE_CTES.strip()
    for name, sql in subst.items():
        text = text.replace("{" + name + "}", sql)
    return text


def landing_select(family: str) -> str:
    return (
        f"SELECT *, cast(ingested_at as date) AS dt, cast(hour(ingested_at) as int) AS hour "
        f"FROM {family}_landing"
    )
