"""Contract validation of raw messages as column expressions; the first failing check wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.contract import (
    ENVELOPE_FIELDS,
    ENVELOPE_RULES,
    MAX_LATENESS_SECONDS,
    PAYLOAD_RULES,
    SKEW_TOLERANCE_SECONDS,
    FieldRule,
)
from kerbside.schemas import EVENT_TYPES, FAMILY_FOR

# A date and time with an offset; text without one names no instant.
_INSTANT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)$"
_SEMVER = r'^"\d+\.\d+\.\d+"$'


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _text_of(variant: str) -> str:
    """SQL for a value's text: strings in quotes, unescaped; `null` for a JSON null."""
    text = f"try_variant_get({variant}, '$', 'string')"
    return (f"CASE WHEN schema_of_variant({variant}) = 'STRING' THEN concat('\"', {text}, '\"') "
            f"ELSE coalesce({text}, 'null') END")


def _values(rules: tuple[FieldRule, ...], source: str) -> str:
    """SQL for the texts of the rules' fields, in the order of the rules."""
    return f"transform(array({_list(r.name for r in rules)}), n -> try_element_at({source}, n))"


def _field_check(rule: FieldRule, json: str, label: str) -> str:
    """SQL giving a message when the field breaks its rule, else NULL.

    `json` is the field's text, whose first character tells the JSON type; allowed values compare
    with their quotes. No pattern allows a quote or a line break.
    """
    number = f"try_cast({json} AS double)"
    is_number = f"{json} RLIKE '^[-0-9]'"
    quoted = f"startswith({json}, '\"')"
    good = [
        {
            "string": quoted,
            "boolean": f"{json} IN ('true', 'false')",
            "number": is_number,
            # A number without a fractional part counts as an integer, however written.
            "integer": f"({json} RLIKE '^-?[0-9]+$' OR ({is_number} AND {number} % 1 = 0))",
            "object": f"startswith({json}, '{{')",
        }[rule.kind]
    ]
    for sign, limit in ((">", rule.gt), (">=", rule.ge), ("<=", rule.le)):
        if limit is not None:
            good.append(f"{number} {sign} {limit}D")
    text = f"CASE WHEN {quoted} THEN length({json}) - 2 END"
    for sign, limit in ((">=", rule.min_length), ("<=", rule.max_length)):
        if limit is not None:
            good.append(f"({text}) {sign} {limit}")
    if rule.one_of is not None:
        values = ", ".join(f"'\"{v}\"'" for v in rule.one_of)
        good = [f"{json} IN ({values})"]
    if rule.pattern is not None:
        inner = rule.pattern.removeprefix("^").removesuffix("$")
        good = [f"{json} RLIKE r'^\"{inner}\"$'"]
    ok = f"coalesce({' AND '.join(good)}, false)"
    if rule.nullable:
        ok = f"({json} = 'null' OR {ok})"
    present = "" if rule.required else f"{json} IS NOT NULL AND "
    return f"CASE WHEN {present}NOT {ok} THEN '{label}[{rule.name}]: {rule.kind} rule broken' END"


def _key_checks(
    rules: tuple[FieldRule, ...], source: str, label: str, known: tuple = ()
) -> tuple[str, str]:
    keys = f"map_keys({source})"
    required = _list(r.name for r in rules if r.required)
    allowed = _list([*(r.name for r in rules), *known])
    missing = f"array_except(array({required}), {keys})"
    extra = f"array_except({keys}, array({allowed}))"
    return (
        f"CASE WHEN size({missing}) > 0 "
        f"THEN concat('{label}: missing ', array_join({missing}, ', ')) END",
        f"CASE WHEN size({extra}) > 0 "
        f"THEN concat('{label}: unexpected ', array_join({extra}, ', ')) END",
    )


def _payload_violation(event_type: str) -> str:
    rules = PAYLOAD_RULES[event_type]
    checks = [*_key_checks(rules, "body", "payload")]
    checks += [_field_check(r, f"fields[{i}]", "payload") for i, r in enumerate(rules)]
    if event_type == "RideCancelled":
        # Before a match there is no driver; after it there must be one.
        at = {r.name: f"fields[{i}]" for i, r in enumerate(rules)}
        early = f"{at['cancelled_at_status']} = '\"REQUESTED\"'"
        checks.append(
            f"CASE WHEN ({at['driver_id']} = 'null') != ({early}) "
            f"THEN 'payload[driver_id]: must be null exactly at REQUESTED' END"
        )
    return f"coalesce({', '.join(checks)})"


def _once(df: DataFrame, **columns: str) -> DataFrame:
    """Add columns that later filters and projections reuse instead of recomputing.

    The optimizer copies expressions into the filters it pushes down; here that would parse
    every message hundreds of times. A generated row keeps them in place.
    """
    # A projection computes them, since it compiles in pieces; the generated row only copies.
    computed = df.selectExpr("*", *[f"{sql} AS _once_{name}" for name, sql in columns.items()])
    fields = ", ".join(f"'{name}', _once_{name}" for name in columns)
    return computed.selectExpr(*df.columns, f"inline(array(named_struct({fields})))")


def validate(raw: DataFrame) -> DataFrame:
    """Raw messages with `reason` and `detail` (NULL when valid) and the typed envelope."""
    text = "CASE WHEN is_valid_utf8(cast(value AS string)) THEN cast(value AS string) END"
    # Brackets around the text make trailing content after the first value an error.
    boxed = f"try_variant_get(try_parse_json(concat('[', {text}, ']')), '$', 'array<variant>')"
    document = _once(raw, boxed=boxed).selectExpr(
        *raw.columns, "CASE WHEN size(boxed) = 1 THEN boxed[0] END AS doc"
    )
    entries = "try_variant_get({}, '{}', 'map<string,variant>')"
    # Of the payload, the head holds only whether it is an object.
    is_object = f"CASE WHEN {entries.format('v', '$')} IS NOT NULL THEN '{{}}' ELSE '' END"
    mapped = _once(
        document,
        head=f"transform_values({entries.format('doc', '$')}, (k, v) -> "
             f"CASE WHEN k = 'payload' THEN {is_object} ELSE {_text_of('v')} END)",
        body=f"transform_values({entries.format('doc', '$.payload')}, (k, v) -> {_text_of('v')})",
    )

    def instant(field: str) -> str:
        stamp = f"try_variant_get(doc, '$.{field}', 'string')"
        return (
            f"CASE WHEN startswith(try_element_at(head, '{field}'), '\"') AND {stamp} RLIKE "
            f"r'{_INSTANT}' THEN try_cast(replace({stamp}, ',', '.') AS timestamp) END"
        )

    event_type = "try_variant_get(doc, '$.event_type', 'string')"
    fields = " ".join(f"WHEN '{t}' THEN {_values(PAYLOAD_RULES[t], 'body')}" for t in EVENT_TYPES)
    parsed = _once(
        mapped,
        event_type=event_type,
        event_timestamp=instant("event_timestamp"),
        ingested_at=instant("ingested_at"),
        outer=_values(ENVELOPE_RULES, "head"),
        fields=f"CASE {event_type} {fields} END",
    )
    drift = "unix_micros(ingested_at) - unix_micros(event_timestamp)"
    missing = f"array_except(array({_list(ENVELOPE_FIELDS)}), map_keys(head))"
    version = "try_element_at(head, 'event_version')"
    written = "to_json(try_variant_get(doc, '$.event_version', 'variant'))"
    envelope = ", ".join(
        [_key_checks(ENVELOPE_RULES, "head", "envelope", ("event_type",))[1]]
        + [_field_check(r, f"outer[{i}]", "envelope") for i, r in enumerate(ENVELOPE_RULES)]
    )
    payload = " ".join(f"WHEN '{t}' THEN {_payload_violation(t)}" for t in EVENT_TYPES)

    def failed(reason: str, detail: str) -> str:
        return f"named_struct('reason', '{reason}', 'detail', {detail})"

    bounds = "TIMESTAMP_OUT_OF_BOUNDS"
    failure = f"""
      CASE
        WHEN doc IS NULL THEN {failed('MALFORMED_JSON', "'not one JSON value'")}
        WHEN head IS NULL THEN {failed('NOT_AN_OBJECT', "'top level is not an object'")}
        WHEN size({missing}) > 0 THEN
          {failed('MISSING_ENVELOPE_FIELD', f"concat('missing: ', array_join({missing}, ', '))")}
        WHEN event_type IS NULL OR event_type NOT IN ({_list(EVENT_TYPES)})
          THEN {failed('UNKNOWN_EVENT_TYPE', "coalesce(event_type, 'null')")}
        WHEN NOT {version} RLIKE r'{_SEMVER}' THEN {failed('INVALID_VERSION', written)}
        WHEN event_timestamp IS NULL OR ingested_at IS NULL
          THEN {failed('INVALID_TIMESTAMP', "'event_timestamp or ingested_at is no instant'")}
        WHEN {drift} < {-SKEW_TOLERANCE_SECONDS}L * 1000000
          THEN {failed(bounds, "'event is ahead of its arrival'")}
        WHEN {drift} > {MAX_LATENESS_SECONDS}L * 1000000
          THEN {failed(bounds, "'event is too late'")}
        ELSE {failed('SCHEMA_VIOLATION', f"coalesce({envelope}, CASE event_type {payload} END)")}
      END"""
    checked = _once(parsed, failure=failure)
    return checked.selectExpr(
        *raw.columns,
        "CASE WHEN failure.detail IS NOT NULL THEN failure.reason END AS reason",
        "failure.detail AS detail",
        *[
            f if f in ("event_type", "event_timestamp", "ingested_at")
            else f"try_variant_get(doc, '$.{f}', 'string') AS {f}"
            for f in ENVELOPE_FIELDS
            if f != "payload"
        ],
        "to_json(try_variant_get(doc, '$.payload', 'variant')) AS payload_json",
    )


def family_of(topic: Column) -> Column:
    family = F.lit("unknown")
    for name, value in FAMILY_FOR.items():
        family = F.when(topic == name, value).otherwise(family)
    return family


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows in landing shape (without the load clock) and rejected rows."""
    valid = validated.where(F.col("reason").isNull()).select(
        "event_id", "event_type", "event_version",
        # The landing zone keeps milliseconds.
        F.date_trunc("millisecond", "event_timestamp").alias("event_timestamp"),
        F.date_trunc("millisecond", "ingested_at").alias("ingested_at"),
        "partition_key", "correlation_id", "causation_id", "producer_service",
        "producer_version", "environment", "payload_json",
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        family_of(F.col("topic")).alias("topic"),
        F.to_date("ingested_at").alias("dt"),
        F.hour("ingested_at").alias("hour"),
    )
    rejected = validated.where(F.col("reason").isNotNull()).select(
        "key", "value", "topic", "partition", "offset", "headers", "reason", "detail"
    )
    return valid, rejected


def rejections_by_reason(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("rejections"))


def reconcile_ingest(
    validated: DataFrame, landed: int | None = None, rejected: int | None = None
) -> DataFrame:
    """Polled against landed + rejected + duplicates dropped, from one pass per key.

    Copies are counted per event id; each id lands once and its other copies are dropped.
    `landed` and `rejected` are the rows that were written; without them the rows that should
    be written stand in, and only the counts are of interest.
    """
    per_id = validated.groupBy(
        F.col("reason").isNull().alias("is_valid"),
        F.when(F.col("reason").isNull(), F.col("event_id")).alias("id"),
    ).agg(F.count(F.lit(1)).alias("copies"))
    return per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("polled"),
        F.count_if("is_valid").alias("landed"),
        F.coalesce(F.sum(F.when(~F.col("is_valid"), F.col("copies"))), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum(F.when(F.col("is_valid"), F.col("copies") - 1)), F.lit(0)).alias(
            "duplicates_dropped"
        ),
    ).withColumns({
        name: F.lit(written).cast("bigint")
        for name, written in (("landed", landed), ("rejected", rejected)) if written is not None
    }).withColumn(
        "reconciles",
        F.col("polled") == F.col("landed") + F.col("rejected") + F.col("duplicates_dropped"),
    )
