"""Column-level helpers: typed JSON extraction, local time, ratios, distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAYLOAD = "payload_json"
EARTH_RADIUS_KM = 6371.0088

# ---- typed extraction ---------------------------------------------------------
# Every cast is a try_cast: one malformed value becomes NULL, it never stops a job.


def payload_sql(field: str, kind: str, source: str | None = None) -> str:
    """SQL for one payload field under its kind.

    `source` is the parsed payload struct; without it the field is read from the JSON text.
    Kinds: text, nullable, int, bigint, money, coord, bool, ts, dec(p,s).
    """
    text = f"{source}.{field}" if source else f"get_json_object({PAYLOAD}, '$.{field}')"
    if kind == "text":
        return text
    if kind == "nullable":
        return f"nullif({text}, '')"
    if kind in ("int", "bigint"):
        # Fractional text rounds to the nearest integer; the exact parse is tried first.
        rounded = f"try_cast(round(try_cast({text} AS decimal(38,6)), 0) AS {kind})"
        return f"coalesce(try_cast({text} AS {kind}), {rounded})"
    target = {
        "money": "decimal(12,2)", "coord": "decimal(9,6)", "bool": "boolean", "ts": "timestamp",
    }.get(kind, kind.replace("dec(", "decimal("))
    return f"try_cast({text} AS {target})"


def payload_text(field: str, source: str | None = None) -> Column:
    return F.expr(payload_sql(field, "text", source))


def payload_text_nullable(field: str, source: str | None = None) -> Column:
    return F.expr(payload_sql(field, "nullable", source))


def payload_int(field: str, source: str | None = None) -> Column:
    return F.expr(payload_sql(field, "int", source))


def payload_bigint(field: str, source: str | None = None) -> Column:
    return F.expr(payload_sql(field, "bigint", source))


def payload_decimal(
    field: str, precision: int = 10, scale: int = 2, source: str | None = None
) -> Column:
    return F.expr(payload_sql(field, f"dec({precision},{scale})", source))


def payload_money(field: str, source: str | None = None) -> Column:
    return F.expr(payload_sql(field, "money", source))


def payload_coordinate(field: str, source: str | None = None) -> Column:
    return F.expr(payload_sql(field, "coord", source))


def payload_bool(field: str, source: str | None = None) -> Column:
    return F.expr(payload_sql(field, "bool", source))


def payload_timestamp(field: str, source: str | None = None) -> Column:
    return F.expr(payload_sql(field, "ts", source))


# ---- local time ---------------------------------------------------------------


def to_local(ts: Column, zone: Column) -> Column:
    return F.from_utc_timestamp(ts, zone)


def local_date_key(ts: Column, zone: Column) -> Column:
    local = to_local(ts, zone)
    return (F.year(local) * 10000 + F.month(local) * 100 + F.dayofmonth(local)).cast("int")


def local_time_key(ts: Column, zone: Column) -> Column:
    local = to_local(ts, zone)
    return (F.hour(local) * 100 + F.minute(local)).cast("int")


def local_hour(ts: Column, zone: Column) -> Column:
    return F.hour(to_local(ts, zone)).cast("smallint")


def unknown_key(column: Column) -> Column:
    """A foreign key is never NULL: a miss points at the -1 member."""
    return F.coalesce(column, F.lit(-1))


# ---- numbers ------------------------------------------------------------------


def round_dp(value: Column, digits: int) -> Column:
    """Round a double at a decimal place by scaling, half away from zero."""
    scale = float(10**digits)
    return F.round(value.cast("double") * F.lit(scale), 0) / F.lit(scale)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL when the denominator is zero or NULL."""
    divisor = denominator.cast("double")
    return numerator.cast("double") / F.nullif(divisor, F.lit(0.0))


def safe_pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """100 * numerator / denominator, rounded; takes sums, never averages of ratios."""
    divisor = denominator.cast("double")
    share = F.lit(100.0) * numerator.cast("double") / F.nullif(divisor, F.lit(0.0))
    return round_dp(share, digits)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    a_lat, b_lat = F.radians(lat1.cast("double")), F.radians(lat2.cast("double"))
    half_dlat = F.radians(lat2.cast("double") - lat1.cast("double")) / 2
    half_dlon = F.radians(lon2.cast("double") - lon1.cast("double")) / 2
    chord = F.pow(F.sin(half_dlat), 2) + F.cos(a_lat) * F.cos(b_lat) * F.pow(F.sin(half_dlon), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))
