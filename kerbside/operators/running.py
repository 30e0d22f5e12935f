"""Running totals and ranks that stay bounded when one key owns most of the rows.

A plain window over a key sends all rows of the key to one task. Here each key's timeline is
cut into fixed time buckets: exact positions are computed inside a bucket, and the totals of
the earlier buckets are added. The only per-key window left runs over one row per bucket, so
its size follows the length of the calendar, not the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 60


def running_totals(
    rows: DataFrame,
    key: str,
    ts: str,
    order: Sequence[str],
    measures: dict[str, Column],
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Add, per measure, its sum over the key's rows up to and including this row.

    Rows order by (`ts`, `*order`), which must be unique within a key. NULL measures add
    nothing.
    """
    bucket = F.floor(F.unix_seconds(ts) / F.lit(bucket_seconds)).cast("bigint")
    source = rows.select(
        "*",
        bucket.alias("_bucket"),
        *[F.coalesce(m, F.lit(0)).alias(f"_m_{n}") for n, m in measures.items()],
    )

    per_bucket = source.groupBy(key, "_bucket").agg(
        *[F.sum(f"_m_{n}").alias(f"_b_{n}") for n in measures]
    )
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        F.col(key).alias("_key"),
        F.col("_bucket").alias("_offset_bucket"),
        *[F.coalesce(F.sum(f"_b_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in measures],
    )

    inside = (
        Window.partitionBy(key, "_bucket")
        .orderBy(ts, *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = source.select(
        "*", *[F.sum(f"_m_{n}").over(inside).alias(f"_l_{n}") for n in measures]
    )
    joined = local.join(
        offsets,
        local[key].eqNullSafe(F.col("_key")) & (local["_bucket"] == F.col("_offset_bucket")),
        "left",
    )
    return joined.select(
        *rows.columns, *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in measures]
    )


def hot_keys(df: DataFrame, key: str, min_rows: int = 1_000_000) -> DataFrame:
    """Keys holding more than `min_rows` rows, whatever the size of the table.

    A table of n rows has fewer than n / `min_rows` of them: 200,000 short ids for 2e11 rows,
    which bounds a broadcast.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.where(F.col("_rows") > min_rows).select(key)
