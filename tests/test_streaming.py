"""The streaming job over several runs of one checkpoint."""

from __future__ import annotations

import time
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from kerbside.bindings.stream_queries import raw_messages
from kerbside.sources.messages import read_landing
from kerbside.streaming.ingest import IngestPaths, drop_copies, start_ingest
from kerbside.streaming.validation import validate

SHAPE = ("event_id string, reason string, ingested_at timestamp, topic string, partition int, "
         "offset long")


def test_copies_go_across_runs_and_late_rows_stay(spark, tmp_path):
    now = datetime.now(UTC).replace(tzinfo=None)
    old = now - timedelta(days=30)
    batches = [
        [("a", None, now, "t", 0, 1), ("b", None, now, "t", 0, 2), ("a", None, now, "t", 0, 3)],
        [("c", None, now + timedelta(days=400), "t", 0, 4), ("x", "BAD", now, "t", 0, 5),
         ("x", "BAD", now, "t", 0, 6), (None, "BAD", None, "t", 0, 7)],
        [("a", None, now, "t", 0, 8), ("d", None, old, "t", 0, 9), ("d", None, old, "t", 0, 10),
         ("e", None, now, "t", 0, 11)],
    ]
    source, found = f"{tmp_path}/in", f"{tmp_path}/out"
    for rows in batches:
        spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").parquet(source)
        stream = drop_copies(spark.readStream.schema(SHAPE).parquet(source))
        stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(
            availableNow=True).start(found).awaitTermination()
    got = sorted((r.event_id or "", r.reason or "") for r in spark.read.parquet(found).collect())
    # Of the copies of `a` one is left; rejects and rows older than the window all pass.
    assert got == [("", "BAD"), ("a", ""), ("b", ""), ("c", ""), ("d", ""), ("d", ""), ("e", ""),
                   ("x", "BAD"), ("x", "BAD")]


def test_ingestion_reports_reasons_copies_and_state(spark, marts, tmp_path):
    raw = raw_messages(marts)
    some = validate(raw.where("topic = 'drivers.presence.v1'")).where("reason is null").orderBy(
        "partition", "offset").select(*raw.columns).limit(20).cache()
    poison = some.limit(1).withColumns({"value": F.lit(b"not json"), "offset": F.lit(10**6).cast("long")})
    copies = some.withColumn("offset", F.col("offset") + 10**7)
    source = f"{tmp_path}/in"
    paths = IngestPaths(f"{tmp_path}/landing", f"{tmp_path}/dlq", f"{tmp_path}/cp",
                        f"{tmp_path}/report", f"{tmp_path}/reasons", f"{tmp_path}/figures",
                        layout=("topic",))
    for rows in (some, poison, copies):
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(raw.schema).parquet(source)
        # The messages are old: a window that holds them.
        start_ingest(stream, paths, {"availableNow": True}, copy_window="20000 days"
                     ).awaitTermination()
    landed = read_landing(spark, paths.landing)
    assert landed.count() == landed.select("event_id").distinct().count() > 5
    # Copies are left out by the state; batches without rows only move the watermark.
    report = spark.read.parquet(paths.report).collect()
    polled = [r for r in sorted(report, key=lambda r: r.batch_id) if r.polled]
    assert [r.rejected for r in polled] == [0, 1] and sum(r.landed for r in report) == landed.count()
    assert all(r.reconciles for r in report)
    reasons = spark.read.parquet(paths.reasons).collect()
    assert [(r.batch_id, r.reason, r.rejections) for r in reasons] == [
        (polled[1].batch_id, "MALFORMED_JSON", 1)]
    for _ in range(60):  # figures come from another thread
        try:
            figures = spark.read.parquet(paths.figures).where("input_rows > 0").collect()
        except Exception:
            figures = []
        if len(figures) >= 3:
            break
        time.sleep(0.5)
    last = max(figures, key=lambda r: r.batch_id)
    assert last.copies_dropped > 5 and last.dropped_by_watermark == 0
    assert last.state_rows >= landed.count() and last.trigger_ms > 0
    some.unpersist()


def test_a_batch_keeps_what_its_writes_read(spark):
    from kerbside.streaming import ingest
    from kerbside.streaming.validation import split, validate

    good = ('{"event_id":"e1","event_type":"Nope"}', "trips.events.v1", 0, 1)
    raw = spark.createDataFrame(
        [(b"k", good[0].encode(), *good[1:], None)],
        "key binary, value binary, topic string, partition int, offset long, "
        "headers array<struct<key:string,value:binary>>")
    judged = validate(raw)
    valid = judged.withColumns({"reason": F.lit(None).cast("string"), "event_id": F.lit("e1")})
    both = judged.unionByName(valid)
    kept = ingest._kept(both)
    assert kept.columns == both.columns
    for part, whole in zip(split(kept), split(both), strict=True):
        assert part.collect() == whole.collect() and part.count() == 1
    rows = {r["reason"] is None: r for r in kept.collect()}
    assert rows[True]["value"] is None and rows[False]["value"] == good[0].encode()


def test_the_state_of_copies_has_one_budget(spark, tmp_path):
    from kerbside.streaming import ingest

    spark.range(0).selectExpr(
        "cast('k' AS binary) AS key", "cast('v' AS binary) AS value", "'t' AS topic",
        "0 AS partition", "id AS offset",
        "cast(NULL AS array<struct<key:string,value:binary>>) AS headers",
    ).write.parquet(f"{tmp_path}/raw")
    schema = spark.read.parquet(f"{tmp_path}/raw").schema
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/raw")
    ingest.start_ingest(stream, ingest.IngestPaths(
        f"{tmp_path}/landing", f"{tmp_path}/dlq", f"{tmp_path}/checkpoint"),
        {"availableNow": True}).awaitTermination()
    rocks = "spark.sql.streaming.stateStore.rocksdb"
    assert spark.conf.get(f"{rocks}.boundedMemoryUsage") == "true"
    assert spark.conf.get(f"{rocks}.maxMemoryUsageMB") == "256"
