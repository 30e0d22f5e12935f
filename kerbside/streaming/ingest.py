"""Streaming ingestion: validate, drop copies of recent batches, land, set rejects aside, then let
the checkpoint commit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.operators.dedup import dedup_batch
from kerbside.shared import shuffles_removed
from kerbside.sources.sinks import dead_letter_rows, write_landing
from kerbside.streaming.metrics import StreamFigures
from kerbside.streaming.validation import (
    reconcile_ingest,
    rejections_by_reason,
    split,
    validate,
)

# Copies are dropped across batches inside the lateness that an event may have.
COPY_WINDOW = "7 days"
_ROCKS = "spark.sql.streaming.stateStore.rocksdb"
# Every partition of the state has buffers and a cache of its own, outside the heap. One budget for
# all of an executor keeps what they take the same, however many partitions and keys there are.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKS}.boundedMemoryUsage": "true",
    f"{_ROCKS}.maxMemoryUsageMB": "256",
}


@dataclass(frozen=True)
class IngestPaths:
    landing: str
    dead_letters: str
    checkpoint: str
    report: str | None = None
    # Rejections by reason of every batch, and figures of every trigger.
    reasons: str | None = None
    figures: str | None = None
    layout: tuple[str, ...] = ("topic", "dt", "hour")


def drop_copies(validated: DataFrame, window: str = COPY_WINDOW) -> DataFrame:
    """A validated stream without copies of valid events that came inside the window.

    The state keeps one key an event for the window. Rows that arrived longer ago, and rejected
    rows, are keys of their own: they pass, whatever the watermark is. The watermark follows the
    arrival time but never passes the clock, so a sender's clock cannot make others late.
    """
    seen = F.least(F.col("ingested_at"), F.current_timestamp())
    recent = F.coalesce(
        F.col("reason").isNull() & F.col("event_id").isNotNull()
        & (seen >= F.current_timestamp() - F.expr(f"INTERVAL {window}")), F.lit(False))
    alone = F.concat_ws("/", F.lit("#"), "topic", "partition", "offset")
    keyed = validated.withColumns({
        "_copy_of": F.when(recent, F.col("event_id")).otherwise(alone),
        "_seen_at": F.when(recent, seen).otherwise(F.current_timestamp()),
    })
    return keyed.withWatermark("_seen_at", window).dropDuplicatesWithinWatermark(
        ["_copy_of"]).drop("_copy_of", "_seen_at")


def _kept(validated: DataFrame) -> DataFrame:
    """What the writes read of a validated batch: valid rows without their message, rejected ones
    without what was read of it. Rows are wide, shuffled to the state and held for three writes."""
    message = ("key", "value", "headers")
    everywhere = ("topic", "partition", "offset", "reason", "detail")
    valid = F.col("reason").isNull()
    return validated.select(*[
        F.when(~valid if c in message else valid, F.col(c)).alias(c)
        if c not in everywhere else F.col(c) for c in validated.columns
    ])


def ingest_batch(
    raw: DataFrame, paths: IngestPaths, batch_id: int = 0, group: str = "trip-ingestor",
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
) -> None:
    """One batch of raw messages: landing write, then dead letters, then the report row."""
    write_batch(_kept(validate(raw)), paths, batch_id, group, clock)


def write_batch(
    validated: DataFrame, paths: IngestPaths, batch_id: int = 0, group: str = "trip-ingestor",
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
) -> None:
    """Land a validated batch, then its dead letters, then its reports.

    A crash between the writes replays the batch. That yields copies, which the
    deduplicated base removes, and never a gap.
    """
    spark = validated.sparkSession
    # Streaming turns adaptive execution off; the landing write needs it to split large hours.
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    now = clock()
    landed, dead = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    validated = validated.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        valid, rejected = split(validated)
        with shuffles_removed(spark):
            write_landing(dedup_batch(valid).observe(landed, rows), paths.landing, now,
                          paths.layout)
            dead_letter_rows(rejected, group, now).observe(dead, rows).write.partitionBy(
                "topic").mode("append").parquet(paths.dead_letters)

        def report(rows: DataFrame, path: str) -> None:
            rows.select(F.lit(batch_id).alias("batch_id"), F.lit(now).alias("landed_at"), "*"
                        ).coalesce(1).write.mode("append").parquet(path)

        if paths.report:
            written = [seen.get.get("rows", 0) for seen in (landed, dead)]
            report(reconcile_ingest(validated, *written), paths.report)
        if paths.reasons:
            report(rejections_by_reason(rejected), paths.reasons)
    finally:
        validated.unpersist()


def start_ingest(
    raw_stream: DataFrame, paths: IngestPaths, trigger: dict | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
    copy_window: str | None = COPY_WINDOW,
) -> StreamingQuery:
    """Run ingestion; `{"availableNow": True}` for a bounded run.

    By default the source says when a batch is due (`read_raw_stream`). Without a `copy_window`
    copies are dropped inside a batch only. The window of a checkpoint must not change from set
    to unset.
    """
    spark = raw_stream.sparkSession
    stream = _kept(validate(raw_stream))
    if copy_window is not None:
        for name, value in STATE.items():
            spark.conf.set(name, value)
        stream = drop_copies(stream, copy_window)
    query = (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: write_batch(batch, paths, batch_id, clock=clock)
        )
        .option("checkpointLocation", paths.checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
    )
    if paths.figures:
        # Before the start, so that no trigger goes unseen.
        StreamFigures.follow(spark, paths.checkpoint, paths.figures)
        query = query.queryName(StreamFigures.name_of(paths.checkpoint))
    return query.start()
