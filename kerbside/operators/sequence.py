"""Causal and arrival order of the events of a trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators.running import hot_keys, running_totals

KEY = "correlation_id"


def sequence_events(
    events: DataFrame, sizes_from: DataFrame | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """Add `event_sequence_number` by event time and `is_out_of_order` against arrival.

    Ordinary trips share one shuffle for both orders. A correlation id holding a large share
    of the table is ranked over time buckets instead, so no task receives all its rows.
    `sizes_from` may name a cheaper superset of the events to find such ids in, `hot` a stored
    table of these ids: where Spark sees that it is small, only the one shuffle is left.
    """
    if hot is None:
        hot = hot_keys(events if sizes_from is None else sizes_from, KEY)
    ordinary = _rank_by_window(events.join(hot, KEY, "left_anti"))
    large = _rank_by_bucket(events.join(hot, KEY, "left_semi"))
    return ordinary.unionByName(large)


def _rank_by_window(events: DataFrame) -> DataFrame:
    by_event = Window.partitionBy(KEY).orderBy("event_timestamp", "event_id")
    by_arrival = Window.partitionBy(KEY).orderBy("ingested_at", "event_id")
    return events.select(
        "*",
        F.row_number().over(by_event).cast("bigint").alias("event_sequence_number"),
        (F.row_number().over(by_event) != F.row_number().over(by_arrival)).alias(
            "is_out_of_order"
        ),
    )


def _rank_by_bucket(events: DataFrame) -> DataFrame:
    one = {"event_sequence_number": F.lit(1).cast("bigint")}
    ranked = running_totals(events, KEY, "event_timestamp", ("event_id",), one)
    one = {"_arrival_number": F.lit(1).cast("bigint")}
    ranked = running_totals(ranked, KEY, "ingested_at", ("event_id",), one)
    return ranked.withColumn(
        "is_out_of_order", F.col("event_sequence_number") != F.col("_arrival_number")
    ).drop("_arrival_number")
