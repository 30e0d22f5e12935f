"""Raw messages derived from landing rows, some broken on purpose; and the contract in DuckDB."""

from __future__ import annotations

from kerbside.bindings.landing_sql import after, iso
from kerbside.contract import (
    ENVELOPE_FIELDS,
    ENVELOPE_RULES,
    MAX_LATENESS_SECONDS,
    PAYLOAD_RULES,
    SKEW_TOLERANCE_SECONDS,
)
from kerbside.schemas import EVENT_TYPES

_D = "kafka_offset % 211"


def raw_value() -> str:
    """Message text over landing columns; the offset decides which defect it gets."""
    def text(name: str, sql: str) -> str:
        return f"'\"{name}\":\"', {sql}, '\",'"

    ingested = (
        f"CASE WHEN {_D} = 8 THEN {iso(after('event_timestamp', '7 * 86400 + 1'))} "
        f"WHEN {_D} = 13 THEN {iso(after('event_timestamp', '-300'))} "
        f"WHEN {_D} = 14 THEN {iso(after('event_timestamp', '-301'))} "
        f"WHEN {_D} = 16 THEN {iso(after('event_timestamp', '7 * 86400'))} "
        f"ELSE {iso('ingested_at')} END"
    )
    stamp = (f"CASE WHEN {_D} = 7 THEN replace({iso('event_timestamp')}, 'Z', '') "
             f"ELSE {iso('event_timestamp')} END")
    payload = (
        f"CASE WHEN {_D} = 10 THEN replace(payload_json, '\"city_id\":', '\"zz\":1,\"city_id\":') "
        f"WHEN {_D} = 17 THEN replace(payload_json, '\"city_id\":', '\"city_id\":\"9\",\"c\":') "
        f"WHEN {_D} = 18 THEN '[]' ELSE payload_json END"
    )
    body = ", ".join([
        "'{'", text("event_id", "event_id"),
        text("event_type", f"CASE WHEN {_D} = 5 THEN 'RideTeleported' ELSE event_type END"),
        text("event_version", f"CASE WHEN {_D} = 6 THEN '1.0' ELSE event_version END"),
        text("event_timestamp", stamp), text("ingested_at", ingested),
        text("partition_key", f"CASE WHEN {_D} = 19 THEN '' ELSE partition_key END"),
        text("correlation_id", "correlation_id"),
        f"CASE WHEN {_D} = 4 THEN '' ELSE concat('\"causation_id\":', "
        "CASE WHEN causation_id IS NULL THEN 'null' ELSE concat('\"', causation_id, '\"') END, ',') END",
        text("producer_service", "producer_service"),
        text("producer_version", "producer_version"),
        text("environment", f"CASE WHEN {_D} = 11 THEN 'moon' ELSE environment END"),
        f"CASE WHEN {_D} = 9 THEN '\"extra\":true,' ELSE '' END",
        f"CASE WHEN {_D} = 15 THEN '\"pay\":1' ELSE concat('\"payload\":', {payload}) END", "'}'",
    ])
    whole = f"concat({body})"
    return (f"CASE {_D} WHEN 1 THEN substr({whole}, 1, 40) WHEN 2 THEN '[1,2]' WHEN 3 THEN '' "
            f"WHEN 12 THEN concat({whole}, ' x') ELSE {whole} END")


RAW_COLUMNS = "kafka_topic AS topic, kafka_partition AS partition, kafka_offset AS offset"


def _duck_field(rule, doc: str, label: str) -> str:
    kind = f"json_type({doc}, '$.{rule.name}')"
    text = f"json_extract_string({doc}, '$.{rule.name}')"
    number = f"try_cast({text} AS double)"
    good = [{
        "string": f"{kind} = 'VARCHAR'",
        "boolean": f"{kind} = 'BOOLEAN'",
        "number": f"{kind} IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT')",
        "integer": f"{kind} IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND floor({number}) = {number}",
        "object": f"{kind} = 'OBJECT'",
    }[rule.kind]]
    good += [f"{number} {sign} {limit}" for sign, limit in
             ((">", rule.gt), (">=", rule.ge), ("<=", rule.le)) if limit is not None]
    good += [f"length({text}) {sign} {limit}" for sign, limit in
             ((">=", rule.min_length), ("<=", rule.max_length)) if limit is not None]
    if rule.one_of is not None:
        good.append(f"{text} IN ({', '.join(repr(v) for v in rule.one_of)})")
    if rule.pattern is not None:
        good.append(f"regexp_matches({text}, '{rule.pattern}')")
    ok = f"coalesce({' AND '.join(good)}, false)"
    if rule.nullable:
        ok = f"({kind} = 'NULL' OR {ok})"
    if not rule.required:
        ok = f"({kind} IS NULL OR {ok})"
    return ok


def _duck_keys(rules, doc: str, known=()) -> str:
    required = ", ".join(repr(r.name) for r in rules if r.required)
    allowed = ", ".join(repr(n) for n in [*(r.name for r in rules), *known])
    return (f"len(list_filter([{required}], lambda x: NOT list_contains(json_keys({doc}), x))) = 0 AND "
            f"len(list_filter(json_keys({doc}), lambda x: NOT list_contains([{allowed}], x))) = 0")


def duck_reason() -> str:
    """Rejection reason of a message `v` as DuckDB SQL."""
    fields = ", ".join(repr(f) for f in ENVELOPE_FIELDS)
    envelope = " AND ".join(
        [_duck_keys(ENVELOPE_RULES, "j", ("event_type",))]
        + [_duck_field(r, "j", "") for r in ENVELOPE_RULES]
    )
    arms = []
    for t in EVENT_TYPES:
        rules = PAYLOAD_RULES[t]
        checks = [_duck_keys(rules, "p")] + [_duck_field(r, "p", "") for r in rules]
        if t == "RideCancelled":
            checks.append("(json_type(p, '$.driver_id') = 'NULL') = "
                          "(json_extract_string(p, '$.cancelled_at_status') = 'REQUESTED')")
        arms.append(f"WHEN '{t}' THEN {' AND '.join(checks)}")
    instant = "'^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:]{8}Z$'"
    get = "json_extract_string(j, '$.{}')".format
    drift = (f"date_diff('second', try_cast({get('event_timestamp')} AS timestamp), "
             f"try_cast({get('ingested_at')} AS timestamp))")
    return f"""CASE WHEN NOT is_json THEN 'MALFORMED_JSON'
      WHEN json_type(j) != 'OBJECT' THEN 'NOT_AN_OBJECT'
      WHEN len(list_filter([{fields}], lambda x: NOT list_contains(json_keys(j), x))) > 0
        THEN 'MISSING_ENVELOPE_FIELD'
      WHEN {get('event_type')} NOT IN ({', '.join(repr(t) for t in EVENT_TYPES)})
        THEN 'UNKNOWN_EVENT_TYPE'
      WHEN NOT regexp_matches({get('event_version')}, '^[0-9]+[.][0-9]+[.][0-9]+$')
        THEN 'INVALID_VERSION'
      WHEN NOT regexp_matches({get('event_timestamp')}, {instant})
        OR NOT regexp_matches({get('ingested_at')}, {instant}) THEN 'INVALID_TIMESTAMP'
      WHEN {drift} < {-SKEW_TOLERANCE_SECONDS} OR {drift} > {MAX_LATENESS_SECONDS}
        THEN 'TIMESTAMP_OUT_OF_BOUNDS'
      WHEN NOT coalesce({envelope}, false) THEN 'SCHEMA_VIOLATION'
      WHEN NOT coalesce(CASE {get('event_type')} {' '.join(arms)} END, false)
        THEN 'SCHEMA_VIOLATION' END"""


def raw_cte() -> str:
    """`raw` (messages) and `judged` (messages with their reason) for DuckDB."""
    both = " UNION ALL ".join(
        f"SELECT *, {raw_value()} AS v FROM {f}_landing" for f in ("trip", "presence")
    )
    return (f", raw AS ({both}), judged AS (SELECT kafka_topic, kafka_partition, kafka_offset, v, "
            f"{duck_reason()} AS reason FROM (SELECT *, json_extract(j, '$.payload') AS p FROM "
            f"(SELECT *, v != '' AND json_valid(v) AS is_json, CASE WHEN v != '' AND "
            f"json_valid(v) THEN v ELSE 'null' END AS j FROM raw)))")
