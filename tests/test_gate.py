"""The gate over all rules, and versions of hot keys."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.operators.staging import typed_events
from kerbside.plans import calendar, gate, quality, scd
from kerbside.schemas import EVENT_TYPES, PRESENCE_EVENT_TYPES

# Trips whose own events break no rule, from whose rows each defect below is made.
def clean_trips(marts):
    known = marts.typed("RideRequested")
    for c, (dim, member) in gate.KNOWN_MEMBERS["RideRequested"].items():
        keys = marts.dims[dim].select(F.col(member).alias(c)).distinct()
        known = known.join(keys, c, "left_semi")
    good = known.where("estimated_fare is not null and rider_id is not null").select("trip_id")
    completed = marts.typed("RideCompleted")
    bad = None
    for rule in quality.COMPLETED_RULES:
        rows = quality.violating(completed, quality.COMPLETED_RULES, rule).select("trip_id")
        bad = rows if bad is None else bad.unionByName(rows)
    paid = marts.typed("PaymentCompleted")
    bad = bad.unionByName(quality.payment_amounts(paid).select("trip_id"))
    bad = bad.unionByName(quality.lifecycle_order(marts.trips).select("trip_id"))
    bad = bad.unionByName(quality.surge_as_quoted(
        marts.typed("RideRequested"), completed).select("trip_id"))
    whole = marts.trips.where("completed_at is not null and cancelled_at is null "
                              "and payment_id is not null").select("trip_id")
    return good.join(bad, "trip_id", "left_anti").join(whole, "trip_id", "left_semi")


@pytest.fixture(scope="module")
def sound(spark, marts):
    ids = clean_trips(marts).cache()
    base = marts.base.join(ids.withColumnRenamed("trip_id", "correlation_id"),
                           "correlation_id", "left_semi").cache()
    presence = marts.presence.where("get_json_object(payload_json, '$.driver_status') <> 'NAPPING'")
    yield {
        "base": base, "presence": presence.cache(),
        "trips": marts.trips.join(ids, "trip_id", "left_semi").cache(),
        "payments": marts.fct_payments.join(ids, "trip_id", "left_semi").cache(),
        "events": marts.fct_trip_events.join(ids, "trip_id", "left_semi").cache(),
        "fct_trips": marts.fct_trips.join(ids, "trip_id", "left_semi").cache(),
    }
    spark.catalog.clearCache()


def judged(spark, marts, tables, times=None):
    typed = {t: typed_events(tables["presence" if t in PRESENCE_EVENT_TYPES else "base"], t)
             for t in EVENT_TYPES}
    found = gate.run_gate(spark, tables["base"], tables["presence"], typed, tables["trips"],
                          tables["payments"], tables["events"], tables["fct_trips"], marts.dims,
                          calendar.dim_time(spark) if times is None else times)
    return {r["rule"] for r in found.where("blocks").collect()}


def test_sound_tables_pass_the_gate(spark, marts, sound):
    assert sound["base"].count() > 100
    assert judged(spark, marts, sound) == set()


def test_a_defect_blocks_by_its_own_rule(spark, marts, sound):
    dearer = sound["payments"].withColumn("trip_fare", F.col("trip_fare") + 1)
    assert judged(spark, marts, sound | {"payments": dearer}) == {"n3_revenue_agrees"}


def test_versions_of_a_hot_key_equal_the_plain_window(spark):
    rng = random.Random(11)
    start = datetime(2026, 3, 1)
    rows = [(rng.choice("xxxy"), start + timedelta(seconds=rng.randrange(900)), f"t{i:04}",
             rng.choice([1, 2, None]), rng.choice("ab")) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, tie string, a int, b string").select(
        "k", "ts", "tie", F.struct("a", "b").alias("_state"))
    key = str
    plain = sorted(scd._versions(df, "k", "ts", "tie").collect(), key=key)
    assert plain == sorted(scd._versions_by_bucket(df, "k", "ts", "tie").collect(), key=key)
