"""Figures of streaming triggers, appended to a table as the query goes on."""

from __future__ import annotations

import hashlib
from typing import ClassVar

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

FIGURES = (
    "run string, batch_id long, at string, input_rows long, trigger_ms long, state_rows long, "
    "state_bytes long, copies_dropped long, dropped_by_watermark long"
)


class StreamFigures(StreamingQueryListener):
    """Appends one row a trigger: rows read, time taken, size of the state, copies dropped."""

    _followed: ClassVar[dict[tuple[str, str], StreamFigures]] = {}

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path

    @staticmethod
    def name_of(checkpoint: str) -> str:
        """The name of the query that goes on from a checkpoint."""
        return f"ingest-{hashlib.md5(checkpoint.encode()).hexdigest()[:12]}"

    @classmethod
    def follow(cls, spark: SparkSession, checkpoint: str, path: str) -> None:
        """Follow the query of a checkpoint; once, however often it is started."""
        key = (spark.sparkContext.applicationId, checkpoint)
        if key not in cls._followed:
            cls._followed[key] = cls(spark, cls.name_of(checkpoint), path)
            spark.streams.addListener(cls._followed[key])

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name:
            return
        state = p.stateOperators
        row = (
            str(p.runId), p.batchId, p.timestamp, p.numInputRows,
            p.durationMs.get("triggerExecution", 0), sum(s.numRowsTotal for s in state),
            sum(s.memoryUsedBytes for s in state),
            sum(s.customMetrics.get("numDroppedDuplicateRows", 0) for s in state),
            sum(s.numRowsDroppedByWatermark for s in state),
        )
        self.spark.createDataFrame([row], FIGURES).coalesce(1).write.mode("append").parquet(
            self.path)
