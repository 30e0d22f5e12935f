"""Reference dimensions: declared types and the bundled members.

Each dimension has a -1 UNKNOWN member, so a failed lookup keeps its fact row and stays
countable.
"""

from __future__ import annotations

import csv
import io

# ---- FIXED VALUES -------------------------------------------------------------
# Declared types per dimension, as DDL, in column order.
DIMENSION_TYPES = {
    "dim_city": (
        "city_id int, city_code string, city_name string, country_code string, region string, "
        "timezone string, currency_code string, center_lat decimal(9,6), center_lon decimal(9,6), "
        "bounding_box_wkt string, commission_pct decimal(5,2), base_fare decimal(10,2), "
        "per_km_rate decimal(10,2), per_min_rate decimal(10,2), airport_fee decimal(10,2), "
        "tax_pct decimal(5,2), max_surge_multiplier decimal(4,2), launch_date date, "
        "is_active boolean"
    ),
    "dim_zone": (
        "zone_id int, zone_code string, zone_name string, city_id int, zone_type string, "
        "centroid_lat decimal(9,6), centroid_lon decimal(9,6), is_airport_zone boolean, "
        "is_surge_eligible boolean, avg_daily_demand int, is_active boolean"
    ),
    "dim_vehicle_type": (
        "vehicle_type_id int, vehicle_type_code string, seat_capacity int, "
        "base_fare_multiplier decimal(4,2), per_km_multiplier decimal(4,2), is_shared boolean, "
        "is_premium boolean, requires_commercial_license boolean, min_driver_rating decimal(3,2), "
        "sort_order int, is_active boolean"
    ),
    "dim_customer_tier": (
        "customer_tier_id int, customer_tier_code string, min_lifetime_trips int, "
        "min_lifetime_spend decimal(12,2), discount_pct decimal(5,2), "
        "has_priority_matching boolean, max_free_cancellations_monthly int, "
        "has_premium_support boolean, tier_rank int, is_active boolean"
    ),
    "dim_payment_method": (
        "payment_method_id int, payment_method_code string, method_category string, "
        "is_cash boolean, is_prepaid boolean, requires_gateway boolean, "
        "settlement_delay_hours int, gateway_fee_pct decimal(5,2), supports_tip boolean, "
        "supports_refund boolean, failure_rate_baseline_pct decimal(5,2), is_active boolean"
    ),
    "dim_payment_status": (
        "payment_status_id int, payment_status_code string, is_terminal boolean, "
        "is_successful boolean, is_revenue_recognised boolean, requires_action boolean, "
        "sort_order int"
    ),
    "dim_ride_status": (
        "ride_status_id int, ride_status_code string, is_terminal boolean, "
        "is_revenue_generating boolean, is_successful boolean, funnel_stage int, "
        "source_event_type string, sort_order int"
    ),
    "dim_cancellation_reason": (
        "cancellation_reason_id int, cancellation_reason_code string, "
        "cancelled_by_party string, reason_category string, is_fee_applicable boolean, "
        "is_driver_fault boolean, is_rider_fault boolean, is_platform_fault boolean, "
        "affects_acceptance_rate boolean, sort_order int"
    ),
    "dim_driver_status": (
        "driver_status_id int, driver_status_code string, is_available_for_dispatch boolean, "
        "is_online boolean, counts_toward_utilisation boolean, is_earning boolean, sort_order int"
    ),
    "dim_weather": (
        "weather_id int, weather_code string, severity_level int, "
        "demand_impact_factor decimal(4,2), supply_impact_factor decimal(4,2), "
        "avg_speed_reduction_pct decimal(5,2), is_adverse boolean, "
        "triggers_safety_protocol boolean"
    ),
    "dim_traffic_level": (
        "traffic_level_id int, traffic_level_code string, severity_rank int, "
        "speed_factor decimal(4,2), eta_multiplier decimal(4,2), avg_speed_kmh decimal(5,2), "
        "is_congested boolean"
    ),
}

# Lookup tables whose ids, codes and rates must equal the reference's for right results.

DIMENSION_ROWS = {
    "dim_city": """
-1,UNKNOWN,Unknown City,XX,UNKNOWN,UTC,XXX,0.0,0.0,"POLYGON((0 0, 0 0, 0 0, 0 0, 0 0))",0.0,0.0,0.0,0.0,0.0,0.0,1.0,1970-01-01,false
1,BLR,Bengaluru,IN,South,Asia/Kolkata,INR,12.976794,77.590082,"POLYGON((77.3101 12.6968, 77.8701 12.6968, 77.8701 13.2568, 77.3101 13.2568, 77.3101 12.6968))",20.00,60.00,18.00,2.00,150.00,5.00,4.00,2021-03-15,true
2,DEL,Delhi NCR,IN,North,Asia/Kolkata,INR,28.613895,77.209006,"POLYGON((76.759 28.1639, 77.659 28.1639, 77.659 29.0639, 76.759 29.0639, 76.759 28.1639))",20.00,55.00,17.00,2.00,200.00,5.00,4.00,2021-06-01,true
3,BOM,Mumbai,IN,West,Asia/Kolkata,INR,19.054999,72.869203,"POLYGON((72.5492 18.735, 73.1892 18.735, 73.1892 19.375, 72.5492 19.375, 72.5492 18.735))",22.00,65.00,19.50,2.20,175.00,5.00,3.50,2021-09-20,true
4,HYD,Hyderabad,IN,South,Asia/Kolkata,INR,17.360589,78.474061,"POLYGON((78.1741 17.0606, 78.7741 17.0606, 78.7741 17.6606, 78.1741 17.6606, 78.1741 17.0606))",20.00,55.00,16.50,1.80,140.00,5.00,4.00,2022-02-14,true
5,MAA,Chennai,IN,South,Asia/Kolkata,INR,13.083694,80.270186,"POLYGON((79.9902 12.8037, 80.5502 12.8037, 80.5502 13.3637, 79.9902 13.3637, 79.9902 12.8037))",20.00,55.00,16.00,1.80,130.00,5.00,4.00,2022-07-11,true
6,PNQ,Pune,IN,West,Asia/Kolkata,INR,18.521374,73.854507,"POLYGON((73.6045 18.2714, 74.1045 18.2714, 74.1045 18.7714, 73.6045 18.7714, 73.6045 18.2714))",20.00,52.00,15.50,1.70,120.00,5.00,4.00,2023-01-09,true
""",
    "dim_zone": """
-1,UNKNOWN,Unknown Zone,1,UNKNOWN,0.0,0.0,false,false,0,false
87,BLR_MG_ROAD,MG Road,1,CBD,12.975526,77.60679,false,true,1450,true
91,BLR_SHIVAJINAGAR,Shivajinagar,1,CBD,12.985529,77.60545,false,true,1120,true
95,BLR_CUBBON,Cubbon Park,1,CBD,12.974253,77.592191,false,true,780,true
99,BLR_MAJESTIC,Majestic,1,TRANSIT_HUB,12.978185,77.572185,false,true,1980,true
104,BLR_KSR_STN,KSR City Railway Station,1,TRANSIT_HUB,12.978174,77.56956,false,true,1640,true
118,BLR_INDIRANAGAR,Indiranagar,1,RESIDENTIAL,12.973291,77.640467,false,true,1720,true
124,BLR_ULSOOR,Ulsoor,1,RESIDENTIAL,12.977879,77.62467,false,true,860,true
131,BLR_MALLESHWARAM,Malleshwaram,1,RESIDENTIAL,13.002735,77.570325,false,true,940,true
137,BLR_RAJAJINAGAR,Rajajinagar,1,RESIDENTIAL,13.000536,77.5497,false,true,810,true
142,BLR_RT_NAGAR,RT Nagar,1,RESIDENTIAL,13.02272,77.595715,false,true,720,true
205,BLR_KORAMANGALA,Koramangala,1,COMMERCIAL,12.935737,77.624081,false,true,2240,true
212,BLR_BTM,BTM Layout,1,RESIDENTIAL,12.914001,77.610282,false,true,1380,true
219,BLR_JAYANAGAR,Jayanagar,1,RESIDENTIAL,12.929273,77.582423,false,true,1090,true
226,BLR_JP_NAGAR,JP Nagar,1,RESIDENTIAL,12.909694,77.586607,false,true,960,true
233,BLR_BANASHANKARI,Banashankari,1,RESIDENTIAL,12.92782,77.556621,false,true,880,true
240,BLR_BASAVANAGUDI,Basavanagudi,1,RESIDENTIAL,12.941726,77.575502,false,true,690,true
260,BLR_HSR,HSR Layout,1,RESIDENTIAL,12.911623,77.638862,false,true,1560,true
318,BLR_MARATHAHALLI,Marathahalli,1,COMMERCIAL,12.955257,77.698416,false,true,1830,true
324,BLR_BELLANDUR,Bellandur,1,COMMERCIAL,12.932049,77.684292,false,true,1670,true
331,BLR_WHITEFIELD,Whitefield,1,COMMERCIAL,12.995743,77.757949,false,true,2010,true
338,BLR_SARJAPUR,Sarjapur Road,1,COMMERCIAL,12.924341,77.644878,false,true,1240,true
412,BLR_KIA_T1,Kempegowda Intl - Terminal 1,1,AIRPORT,13.197605,77.707486,true,true,1890,true
415,BLR_KIA_T2,Kempegowda Intl - Terminal 2,1,AIRPORT,13.197605,77.707486,true,true,1240,true
421,BLR_HEBBAL,Hebbal,1,SUBURBAN,13.038218,77.5919,false,true,1150,true
434,BLR_MANYATA,Manyata Tech Park,1,COMMERCIAL,13.048289,77.6211,false,true,1420,true
512,BLR_ELECTRONIC_CITY,Electronic City,1,COMMERCIAL,12.84876,77.648253,false,true,1760,true
""",
    "dim_vehicle_type": """
-1,UNKNOWN,0,1.00,1.00,false,false,false,1.00,99,false
1,ECONOMY,4,1.00,1.00,false,false,true,4.00,10,true
2,PREMIUM,4,1.60,1.55,false,true,true,4.60,20,true
3,XL,6,1.85,1.70,false,false,true,4.30,30,true
4,POOL,4,0.70,0.65,true,false,true,4.20,40,true
5,AUTO,3,0.55,0.50,false,false,true,4.00,50,true
6,BIKE,1,0.35,0.32,false,false,false,4.00,60,true
""",
    "dim_customer_tier": """
-1,UNKNOWN,0,0.00,0.00,false,0,false,0,false
1,BASIC,0,0.00,0.00,false,1,false,1,true
2,SILVER,25,7500.00,2.50,false,2,false,2,true
3,GOLD,100,35000.00,5.00,true,4,true,3,true
4,PLATINUM,300,120000.00,8.00,true,8,true,4,true
""",
    "dim_payment_method": """
-1,UNKNOWN,UNKNOWN,false,false,false,0,0.00,false,false,0.00,false
1,CASH,CASH,true,false,false,0,0.00,false,false,0.00,true
2,CARD,CARD,false,false,true,48,2.00,true,true,2.80,true
3,UPI,DIGITAL,false,false,true,24,0.30,true,true,0.90,true
4,WALLET,DIGITAL,false,true,false,0,0.00,true,true,0.40,true
5,CORPORATE,ACCOUNT,false,false,false,720,0.00,false,true,0.20,true
6,NETBANKING,DIGITAL,false,false,true,48,1.20,true,true,3.40,true
""",
    "dim_payment_status": """
-1,UNKNOWN,false,false,false,true,99
1,PENDING,false,false,false,false,10
2,AUTHORIZED,false,false,false,false,20
3,SUCCEEDED,true,true,true,false,30
4,FAILED,true,false,false,true,40
5,REFUNDED,true,false,false,false,50
6,PARTIALLY_REFUNDED,true,false,true,false,60
7,CHARGEBACK,true,false,false,true,70
8,DISPUTED,false,false,true,true,80
""",
    "dim_ride_status": """
-1,UNKNOWN,false,false,false,0,,99
1,REQUESTED,false,false,false,1,RideRequested,10
2,MATCHED,false,false,false,2,RideAccepted,20
3,DRIVER_ARRIVED,false,false,false,3,DriverArrived,30
4,STARTED,false,false,false,4,RideStarted,40
5,COMPLETED,false,true,true,5,RideCompleted,50
6,PAID,true,true,true,6,PaymentCompleted,60
7,CANCELLED_RIDER,true,false,false,99,RideCancelled,70
8,CANCELLED_DRIVER,true,false,false,99,RideCancelled,80
9,CANCELLED_SYSTEM,true,false,false,99,RideCancelled,90
10,EXPIRED,true,false,false,99,,95
""",
    "dim_cancellation_reason": """
-1,UNKNOWN,SYSTEM,OPERATIONAL,false,false,false,false,false,99
1,RIDER_CHANGED_MIND,RIDER,DEMAND,true,false,true,false,false,10
2,DRIVER_ETA_TOO_LONG,RIDER,SUPPLY,true,false,false,false,false,20
3,RIDER_FOUND_ALTERNATIVE,RIDER,DEMAND,true,false,true,false,false,30
4,WRONG_PICKUP_LOCATION,RIDER,OPERATIONAL,false,false,true,false,false,40
5,RIDER_UNRESPONSIVE,DRIVER,DEMAND,true,false,true,false,false,50
6,PRICE_TOO_HIGH,RIDER,DEMAND,false,false,false,false,false,60
7,DRIVER_VEHICLE_ISSUE,DRIVER,SUPPLY,false,true,false,false,true,70
8,DRIVER_TOO_FAR,DRIVER,SUPPLY,false,true,false,false,true,80
9,DRIVER_EMERGENCY,DRIVER,SAFETY,false,false,false,false,false,90
10,DRIVER_DECLINED_DESTINATION,DRIVER,SUPPLY,false,true,false,false,true,100
11,NO_DRIVER_AVAILABLE,SYSTEM,SUPPLY,false,false,false,true,false,110
12,PAYMENT_METHOD_INVALID,SYSTEM,TECHNICAL,false,false,true,false,false,120
13,SAFETY_CONCERN,SYSTEM,SAFETY,false,false,false,false,false,130
14,DUPLICATE_REQUEST,SYSTEM,TECHNICAL,false,false,false,true,false,140
15,SYSTEM_ERROR,SYSTEM,TECHNICAL,false,false,false,true,false,150
""",
    "dim_driver_status": """
-1,UNKNOWN,false,false,false,false,99
1,AVAILABLE,true,true,true,false,10
2,EN_ROUTE,false,true,true,false,20
3,ON_TRIP,false,true,true,true,30
4,BREAK,false,true,false,false,40
5,OFFLINE,false,false,false,false,50
6,SUSPENDED,false,false,false,false,60
""",
    "dim_weather": """
-1,UNKNOWN,0,1.00,1.00,0.00,false,false
1,CLEAR,0,1.00,1.00,0.00,false,false
2,CLOUDY,0,1.02,1.00,0.00,false,false
3,RAIN_LIGHT,1,1.25,0.92,8.00,true,false
4,RAIN_HEAVY,2,1.60,0.75,22.00,true,true
5,THUNDERSTORM,3,1.45,0.55,30.00,true,true
6,FOG,2,1.10,0.85,25.00,true,true
7,EXTREME_HEAT,2,1.30,0.88,3.00,true,false
""",
    "dim_traffic_level": """
-1,UNKNOWN,0,1.00,1.00,0.00,false
1,FREE_FLOW,1,1.00,1.00,32.00,false
2,LIGHT,2,0.85,1.15,27.00,false
3,MODERATE,3,0.65,1.50,21.00,true
4,HEAVY,4,0.45,2.10,14.00,true
5,GRIDLOCK,5,0.25,3.60,8.00,true
""",
}

# ---- end of fixed values ------------------------------------------------------


def dimension_columns(name: str) -> list[tuple[str, str]]:
    """(column, type) pairs, in order."""
    pairs, depth, start = [], 0, 0
    ddl = DIMENSION_TYPES[name] + ","
    for i, ch in enumerate(ddl):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            column, type_name = ddl[start:i].strip().split(" ", 1)
            pairs.append((column, type_name))
            start = i + 1
    return pairs


def dimension_rows(name: str) -> list[list[str]]:
    """Bundled members as text, one list per row."""
    return list(csv.reader(io.StringIO(DIMENSION_ROWS[name].strip())))


def values_sql(name: str) -> str:
    """The bundled members as a typed VALUES query, valid in any ANSI SQL engine."""
    columns = dimension_columns(name)

    def literal(text: str) -> str:
        return "NULL" if text == "" else "'" + text.replace("'", "''") + "'"

    rows = ", ".join(
        "(" + ", ".join(literal(cell) for cell in row) + ")" for row in dimension_rows(name)
    )
    selected = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in columns)
    names = ", ".join(c for c, _ in columns)
    return f"SELECT {selected} FROM (VALUES {rows}) AS t({names})"
