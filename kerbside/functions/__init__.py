from kerbside.functions.scalars import (
    haversine_km,
    local_date_key,
    local_hour,
    local_time_key,
    payload_bigint,
    payload_bool,
    payload_coordinate,
    payload_decimal,
    payload_int,
    payload_money,
    payload_text,
    payload_text_nullable,
    payload_timestamp,
    round_dp,
    safe_pct,
    safe_ratio,
    to_local,
    unknown_key,
)

__all__ = [
    "haversine_km", "local_date_key", "local_hour", "local_time_key", "payload_bigint",
    "payload_bool", "payload_coordinate", "payload_decimal", "payload_int", "payload_money",
    "payload_text", "payload_text_nullable", "payload_timestamp", "round_dp", "safe_pct",
    "safe_ratio", "to_local", "unknown_key",
]
