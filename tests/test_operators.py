"""Operators against brute force on small fixtures, skewed keys included."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from kerbside import shared
from kerbside.operators import assembly, dedup, quantiles, running, sequence, staging
from kerbside.operators.joins import drill_across, lookup_keys
from kerbside.plans import incremental, marketplace, quality
from kerbside.shared import shared_dir, written_apart

T0 = datetime(2026, 3, 17, 2, 0)


def test_running_totals_equal_a_plain_scan(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), T0 + timedelta(seconds=rng.randrange(600)), i, rng.randrange(9))
            for i in range(400)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int, v int")
    got = {r["id"]: r["total"] for r in running.running_totals(
        df, "k", "ts", ("id",), {"total": F.col("v")}).collect()}
    want, sums = {}, {"a": 0, "b": 0}
    for k, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        sums[k] += v
        want[i] = sums[k]
    assert got == want


def test_both_ranking_paths_agree(spark):
    rng = random.Random(5)
    rows = [(f"e{i}", rng.choice(["x", "y"]), T0 + timedelta(seconds=rng.randrange(900)),
             T0 + timedelta(seconds=rng.randrange(900))) for i in range(300)]
    df = spark.createDataFrame(
        rows, "event_id string, correlation_id string, event_timestamp timestamp, "
        "ingested_at timestamp")
    cols = ["event_id", "event_sequence_number", "is_out_of_order"]
    plain = sequence._rank_by_window(df).select(*cols)
    bucketed = sequence._rank_by_bucket(df).select(*cols)
    assert sorted(plain.collect()) == sorted(bucketed.collect())


def test_hot_keys_are_found_and_bounded(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, "hot").otherwise(
        F.col("id").cast("string")).alias("k"))
    found = running.hot_keys(df, "k", min_rows=100).collect()
    assert [r["k"] for r in found] == ["hot"]


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_exact_median(spark, n):
    rng = random.Random(n)
    values = [rng.randrange(-5000, 100_000) for _ in range(n)]
    df = spark.createDataFrame([(1, v) for v in values], "g int, v bigint")
    got = quantiles.exact_median(df, ["g"], "v", "m").first()["m"]
    s = sorted(values)
    assert got == (s[(n - 1) // 2] + s[n // 2]) / 2


def test_drill_across_refuses_a_repeated_grain(spark):
    left = spark.createDataFrame([(1, 5)], "k int, a int")
    right = spark.createDataFrame([(1, 1), (1, 2)], "k int, b int")
    with pytest.raises(Exception, match="repeats"):
        drill_across(left, right, ["k"]).collect()


def test_surge_grid_against_the_recurrence(spark):
    rng = random.Random(11)
    rows = [(z, b, rng.randrange(0, 14), rng.randrange(0, 3))
            for z in (1, 2, 3) for b in range(40) if rng.random() < 0.9]
    supplied = spark.createDataFrame(rows, "zone_id int, bucket bigint, demand bigint, supply bigint")
    zones = spark.createDataFrame([(1, 1, True), (2, 1, True), (3, 1, False)],
                                  "zone_id int, city_id int, is_surge_eligible boolean")
    cities = spark.createDataFrame([(1, Decimal("3.50"))],
                                   "city_id int, max_surge_multiplier decimal(4,2)")
    got = {(r["zone_id"], r["bucket"]): r["multiplier"]
           for r in marketplace.surge_grid(supplied, zones, cities).collect()}
    prior, want = {}, {}
    for z, b, d, s in sorted(rows):
        if d < 3:
            prior[z] = want[z, b] = Decimal("1.0")
            continue
        rate = d * 6.0 / max(max(s * 1.35, 2.0) * 1.9, 1.0)
        raw = Decimal(str(1.0 + 1.5 * max(0.0, rate - 0.72)))
        if z in prior:
            raw = prior[z] + Decimal("0.35") * (raw - prior[z])
        m = min(max(raw, Decimal("1.0")), Decimal("3.5")) / Decimal("0.1")
        m = min(m.quantize(Decimal(1), ROUND_HALF_EVEN) * Decimal("0.1"), Decimal("3.5"))
        prior[z] = want[z, b] = m
    want = {k: (Decimal("1.0") if k[0] == 3 else v) for k, v in want.items()}
    assert got == want


def test_half_a_backfill_window_is_an_error():
    with pytest.raises(ValueError, match="start and end"):
        incremental.arrival_window(None, backfill=("2026-01-01", None))


def test_replacement_moves_rows_between_partitions(spark):
    target = f"{shared_dir(spark)}/replace-test"
    schema = "id string, day int, v int"
    part = F.col("day")
    first = spark.createDataFrame([("a", None, 1), ("b", 20260101, 2), ("c", 20260102, 3)], schema)
    incremental.replace_by_key(spark, target, first, "id", part)
    second = spark.createDataFrame([("a", 20260102, 9)], schema)
    for _ in range(2):
        incremental.replace_by_key(spark, target, second, "id", part)
        rows = sorted((r["id"], r["v"]) for r in spark.read.parquet(target).collect())
        assert rows == [("a", 9), ("b", 2), ("c", 3)]


def test_content_hash_ignores_order_and_sees_nulls(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "i int, s string")
    b = a.orderBy(F.col("i").desc())
    c = spark.createDataFrame([(1, ""), (2, "x")], "i int, s string")
    h = [incremental.content_hash(d).first()["content_hash"] for d in (a, b, c)]
    assert h[0] == h[1] != h[2]


def test_gate_blocks_on_errors_only(spark):
    one = spark.range(1)
    gate = quality.quality_gate({"w": (quality.WARN, one), "e": (quality.ERROR, one.limit(0))})
    assert len(quality.enforce(gate)) == 2
    with pytest.raises(quality.GateBlocked, match="e: 1"):
        quality.enforce(quality.quality_gate({"e": (quality.ERROR, one)}))


def test_dimensions_hold_their_rules(spark, marts):
    dims = marts.dims
    assert quality.unknown_member_exists(dims).isEmpty()
    assert quality.zone_outside_city(dims["dim_zone"], dims["dim_city"]).isEmpty()
    assert quality.city_prices_positive(dims["dim_city"]).isEmpty()
    assert quality.vehicle_price_order(dims["dim_vehicle_type"]).isEmpty()
    assert quality.time_dimension_complete(marts.dim_time).isEmpty()
    assert quality.session_zone_is_utc(spark).isEmpty()
    moved = dims["dim_zone"].withColumn("centroid_lat", F.lit(50))
    assert not quality.zone_outside_city(moved, dims["dim_city"]).isEmpty()


def test_dedup_plan_limits_each_key_before_the_shuffle(marts):
    plan = marts.build_base()._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_rows_that_may_have_copies_are_flagged(spark):
    rng = random.Random(11)
    rows = [(rng.choice([f"e{i}", f"e{i % 40}", None]), T0 + timedelta(seconds=rng.randrange(50)),
             rng.randrange(3), "t", 0, i) for i in range(2_000)]
    rows += [("same", T0, 1, "t", 0, -1)] * 3
    df = spark.createDataFrame(rows, "event_id string, ingested_at timestamp, kafka_offset long, "
                               "kafka_topic string, kafka_partition int, n long")
    marked = dedup.mark_repeated(df)
    copies = {k for k in {r[0] for r in rows} if sum(r[0] == k for r in rows) > 1}
    found = marked.collect()
    assert sorted(map(str, (r[:6] for r in found))) == sorted(map(str, rows))
    assert all(r["_repeats"] for r in found if r["event_id"] in copies)
    # A few lone rows may share a bit with a repeated key.
    assert sum(r["_repeats"] for r in found if r["event_id"] not in copies) < 20
    once = df.where("event_id is not null").dropDuplicates(["event_id"])
    assert dedup.mark_repeated(once).where("_repeats").isEmpty()


def test_many_repeated_keys_flag_few_others(spark, monkeypatch):
    monkeypatch.setattr(dedup, "_WORDS", 16)  # a hundred keys in 1,024 bits
    df = spark.sql("SELECT id % 5100 AS event_id FROM range(5200)")
    marked = dedup.mark_repeated(df).where("_repeats").select("event_id").collect()
    found = [r.event_id for r in marked]
    assert all(found.count(k) == 2 for k in range(100))
    assert len(found) - 200 < 250


def test_stored_base_shuffles_only_rows_with_copies(spark, marts):
    columns = ["event_id", "kafka_offset", "payload_json", "landed_at"]
    assert sorted(map(str, marts.base.select(*columns).collect())) == sorted(
        map(str, marts.build_base().select(*columns).collect()))
    marked = staging.marked_events(marts.build_landing())
    plan = marked._jdf.queryExecution().optimizedPlan().treeString()
    assert "Window" not in plan
    assert marts.base._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0


def test_flagged_tables_may_be_empty(spark):
    rows = spark.createDataFrame([(1, "x")], "n int, s string")
    kept = written_apart(spark, "flags", "empty", lambda: rows.select(
        "*", (F.col("n") > 1).alias("f")).where("n > 5"), "f")
    assert kept.columns == ["n", "s", "f"] and kept.isEmpty()
    one = written_apart(spark, "flags", "one", lambda: rows.select(
        "*", (F.col("n") > 1).alias("f")), "f")
    assert one.where("f").isEmpty() and one.where("not f").count() == 1


def test_a_write_has_its_settings_and_leaves_none(spark):
    seen, names = [], (shared.WRITERS, shared.LEAST_TASKS)
    before = [spark.conf.get(name, None) for name in names]
    with shared._writing(spark):
        seen = [spark.conf.get(name) for name in names]
    assert seen == ["2", str(4 * spark.sparkContext.defaultParallelism)]
    assert [spark.conf.get(name, None) for name in names] == before


def _joins(plan) -> list:
    below = [plan.children().apply(i) for i in range(plan.children().length())]
    found = [join for child in below for join in _joins(child)]
    return [plan, *found] if plan.nodeName() == "Join" else found


def test_lookups_pass_the_fact_as_one_column(spark, marts):
    plan = marts.build_fct_trips()._jdf.queryExecution().optimizedPlan()
    wide = [join for join in _joins(plan) if join.output().length() > 40]
    assert len(wide) == 1  # the one with the cities' time zones


def test_a_repeated_code_or_a_null_one_in_a_lookup(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, code string")
    dim = spark.createDataFrame([("a", 7), ("a", 8), (None, 9)], "c string, id int")
    found = lookup_keys(fact, {"key": ("code", dim, "c", "id")})
    assert found.columns == ["n", "code", "key"]
    assert sorted(map(tuple, found.select("n", "key").collect())) == [
        (1, 7), (1, 8), (2, -1), (3, -1)]
    assert lookup_keys(fact, {"key": ("code", dim, "c", "id")}, ["n"]).columns == ["n", "key"]


def test_each_event_is_parsed_for_its_own_fields(spark, marts):
    plan = assembly.trips_from_base(marts.base)._jdf.queryExecution().optimizedPlan().toString()
    parsed = [line for line in plan.splitlines() if "_json_pay" in line and "from_json" in line]
    assert parsed and all("StructField(tax_amount" not in line.split("PaymentCompleted")[-1]
                          for line in parsed)
    # A row of another type, or without an object, has no fields; a trip's id comes from any type.
    at = "timestamp'2026-03-17 02:00:00'"
    base = spark.sql(f"""
      SELECT * FROM VALUES
        ('e1', 'RideRequested', 't', '{{"trip_id":"t","requested_at":"2026-03-17T02:00:00Z"}}'),
        ('e2', 'RideCompleted', 't', '{{"trip_id":"t","tax_amount":1.50,"requested_at":"x"}}'),
        ('e3', 'PaymentCompleted', 't', '[]'), ('e4', 'RideCompleted', 'u', 'not json')
      AS (event_id, event_type, correlation_id, payload_json)""").selectExpr(
        "*", f"{at} AS event_timestamp", f"{at} AS ingested_at", "0.0D AS lateness_sec",
        "false AS is_late_arrival_event")
    (trip,) = assembly.trips_from_base(base).collect()
    assert (trip["trip_id"], str(trip["tax_amount"]), trip["event_count"], trip["is_paid"]) == (
        "t", "1.50", 3, False)
    assert trip["requested_at"] is not None


def test_trips_sort_only_what_they_take(marts):
    plan = assembly.trips_from_base(marts.base)._jdf.queryExecution().optimizedPlan()
    assert "gateway_reference" not in plan.treeString()


def test_replacement_survives_empty_deltas(spark, tmp_path):
    from kerbside.plans import incremental as I

    target = f"{tmp_path}/t"
    rows = spark.createDataFrame([("a", 20260101, 1), ("b", 20260102, 1)], "k string, d int, v int")
    for part in (rows.limit(0), rows, rows.limit(0), rows.where("k = 'b'").selectExpr(
            "k", "d + 1 AS d", "2 AS v")):
        I.replace_by_key(spark, target, part, "k", F.col("d"))
    got = {(r.k, r.d, r.v, r.part_date) for r in spark.read.parquet(target).collect()}
    assert got == {("a", 20260101, 1, 20260101), ("b", 20260103, 2, 20260103)}


def test_arrival_window_reaches_the_scan(spark, tmp_path):
    from kerbside.plans import incremental as I

    rows = spark.sql("SELECT timestamp'2026-01-01' AS landed_at, "
                     "timestamp'2026-01-01' AS ingested_at, 'c' AS correlation_id")
    rows.write.parquet(f"{tmp_path}/l")
    window = I.arrival_window(None, backfill=("2026-01-01", "2026-01-02"))
    found = I.touched_trips(spark.read.parquet(f"{tmp_path}/l"), window)
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "GreaterThanOrEqual(landed_at" in pushed and found.count() == 1


def test_dead_letters_are_unwrapped(spark):
    import base64
    import json

    from kerbside.sources import sinks

    row = spark.createDataFrame(
        [(b"k", b"x" * 400, "rides.trip-events.v1", 0, 1, [], "bad", "why")],
        "key binary, value binary, topic string, partition int, offset long, "
        "headers array<struct<key: string, value: binary>>, reason string, detail string")
    from datetime import UTC, datetime

    out = sinks.dead_letter_rows(row, "g", datetime(2026, 1, 1, tzinfo=UTC)).first()
    assert json.loads(bytes(out.value))["original_value_base64"] == base64.b64encode(
        b"x" * 400).decode()


def test_compaction_repeats_without_copies(spark, marts, tmp_path):
    from kerbside.sources.sinks import write_landing

    source, target = f"{tmp_path}/landing", f"{tmp_path}/compact"
    dt = marts.landing.selectExpr("min(cast(ingested_at AS date))").first()[0]
    day = marts.landing.where(F.col("ingested_at").cast("date") == F.lit(dt))
    write_landing(day, source, datetime(2026, 1, 1))
    written = spark.read.parquet(source)
    for closed in [r[0] for r in written.select("dt").distinct().collect()] * 2:
        incremental.compact(spark, source, str(closed), target)
    assert spark.read.parquet(target).count() == written.count() > 0


def test_causes_must_be_strictly_earlier(spark):
    t = [T0 + timedelta(seconds=s) for s in range(3)]
    rows = [("root", None, t[0]), ("fine", "root", t[1]), ("early", "fine", t[0]),
            ("self", "self", t[1]),
            ("x", "z", t[2]), ("y", "x", t[2]), ("z", "y", t[2])]
    base = spark.createDataFrame(rows, "event_id string, causation_id string, "
                                       "event_timestamp timestamp")
    got = {(r["event_id"], r["issue"]) for r in quality.causal_order(base).collect()}
    assert got == {("early", "before_cause"), ("self", "own_cause"), ("x", "at_cause"),
                   ("y", "at_cause"), ("z", "at_cause")}


def test_lifecycle_order_reads_trips_without_a_request(spark):
    stages = ("requested_at", "accepted_at", "arrived_at", "started_at", "completed_at", "paid_at")
    minutes = {"sound": (0, 1, 2, 3, 4, 5), "early": (0, 0, 2, 3, 4, 5),
               "orphan": (None, 1, 2, 3, 4, 3), "gaps": (None, None, 2, None, 1, 1)}
    rows = [(name, *(None if m is None else T0 + timedelta(minutes=m) for m in times))
            for name, times in minutes.items()]
    trips = spark.createDataFrame(
        rows, "trip_id string, " + ", ".join(f"{s} timestamp" for s in stages))
    got = {r["trip_id"] for r in quality.lifecycle_order(trips).collect()}
    assert got == {"early", "orphan"}


def test_every_null_key_is_reported(spark):
    left = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    right = spark.createDataFrame([("b",)], "k string")
    from kerbside.operators.joins import key_difference

    got = sorted(r["issue"] for r in key_difference(left, right, "k").collect())
    assert got == ["missing_from_right", "not_in_left", "null_key", "null_key"]


def test_dimensions_from_csv_equal_the_bundled_ones(spark, tmp_path):
    from kerbside.sources.dimensions import load_dimension

    for name in ("dim_city", "dim_payment_method"):
        bundled = load_dimension(spark, name)
        bundled.write.option("header", True).csv(f"{tmp_path}/{name}.csv")
        read = load_dimension(spark, name, str(tmp_path))
        assert read.dtypes == bundled.dtypes
        assert sorted(read.collect()) == sorted(bundled.collect())


def test_stream_dedup_drops_copies_of_earlier_batches(spark, tmp_path):
    from kerbside.operators.dedup import dedup_stream

    schema = "event_id string, ingested_at timestamp"
    source, found = f"{tmp_path}/in", f"{tmp_path}/out"
    for batch in ([("a", T0), ("b", T0), ("a", T0)], [("b", T0), ("c", T0)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        # Each run goes on from the checkpoint of the one before.
        stream = dedup_stream(spark.readStream.schema(schema).parquet(source))
        stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(
            availableNow=True).start(found).awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(found).collect()) == ["a", "b", "c"]
