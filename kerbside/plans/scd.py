"""Driver and rider versions accumulated from their own history (type 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions import safe_pct
from kerbside.operators.running import BUCKET_SECONDS, hot_keys


def scd2(
    history: DataFrame, key: str, attrs: list[str], ts: str, tie: str
) -> DataFrame:
    """One row per key and run of unchanged attributes, valid from its first observation.

    A key with very many observations is cut into time buckets: each bucket gets the last
    state before it and the first change after it, so no task receives all rows of the key.
    """
    rows = history.select(key, ts, tie, F.struct(*attrs).alias("_state"))
    hot = hot_keys(rows, key)
    ordinary = _versions(rows.join(hot, key, "left_anti"), key, ts, tie)
    large = _versions_by_bucket(rows.join(hot, key, "left_semi"), key, ts, tie)
    return ordinary.unionByName(large).select(
        key, *[F.col(f"_state.{a}").alias(a) for a in attrs],
        F.col(ts).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"),
    )


def _versions(rows: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """(key, ts, _state, valid_to) of every row whose state differs from the row before."""
    order = Window.partitionBy(key).orderBy(ts, tie)
    # A state is never NULL, so a NULL before it means that the row is the key's first.
    before = rows.withColumn("_before", F.lag("_state").over(order))
    changes = before.where(~F.col("_state").eqNullSafe(F.col("_before")))
    return changes.select(key, ts, "_state", F.lead(ts).over(order).alias("valid_to"))


def _versions_by_bucket(rows: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """The same, with windows over a bucket's rows and over one row per bucket only."""
    rows = rows.withColumn("_bucket", F.floor(F.unix_seconds(ts) / F.lit(BUCKET_SECONDS)))
    bucket, inside = [key, "_bucket"], Window.partitionBy(key, "_bucket").orderBy(ts, tie)
    across = Window.partitionBy(key).orderBy("_bucket")
    last = rows.groupBy(*bucket).agg(F.max_by("_state", F.struct(ts, tie)).alias("_last"))
    carried = last.select(*bucket, F.lag("_last").over(across).alias("_carried"))
    before = rows.withColumn("_before", F.lag("_state").over(inside)).join(carried, bucket)
    changes = before.where(
        ~F.col("_state").eqNullSafe(F.coalesce("_before", "_carried"))
    ).select(*bucket, ts, tie, "_state")
    first = changes.groupBy(*bucket).agg(F.min(ts).alias("_first"))
    following = first.select(*bucket, F.lead("_first").over(across).alias("_next"))
    return changes.withColumn("_later", F.lead(ts).over(inside)).join(following, bucket).select(
        key, ts, "_state", F.coalesce("_later", "_next").alias("valid_to"))


def dim_driver_versions(trips: DataFrame) -> DataFrame:
    """Versions of a driver's rating and city as seen at acceptance."""
    seen = trips.where(F.col("driver_id").isNotNull() & F.col("accepted_at").isNotNull()).select(
        "driver_id", "trip_id", "accepted_at", "city_id",
        F.col("driver_rating_at_accept").alias("current_rating"),
    )
    return scd2(seen, "driver_id", ["city_id", "current_rating"], "accepted_at", "trip_id")


def dim_rider_versions(trips: DataFrame) -> DataFrame:
    """Versions of a rider's tier and city as seen at request."""
    seen = trips.where(F.col("rider_id").isNotNull() & F.col("requested_at").isNotNull()).select(
        "rider_id", "trip_id", "requested_at", "city_id", "customer_tier"
    )
    return scd2(seen, "rider_id", ["city_id", "customer_tier"], "requested_at", "trip_id")


def driver_lifetime(trips: DataFrame) -> DataFrame:
    first = F.coalesce("accepted_at", "arrived_at", "started_at", "completed_at", "paid_at",
                       "cancelled_at")
    return trips.where(F.col("driver_id").isNotNull()).groupBy("driver_id").agg(
        F.min(first).alias("first_seen_at"),
        F.count("completed_at").alias("lifetime_trips"),
        F.coalesce(F.sum("driver_payout"), F.lit(0)).cast("decimal(14,2)").alias(
            "lifetime_earnings"
        ),
    )


def rider_lifetime(trips: DataFrame, payments: DataFrame) -> DataFrame:
    charged = payments.select("payment_id", "amount_charged")
    return (
        trips.where(F.col("rider_id").isNotNull())
        .join(charged, "payment_id", "left")
        .groupBy("rider_id")
        .agg(
            F.count("completed_at").alias("lifetime_trips"),
            F.coalesce(F.sum("amount_charged"), F.lit(0)).cast("decimal(14,2)").alias(
                "lifetime_spend"
            ),
            safe_pct(F.count_if(F.col("cancelled_by") == "RIDER"), F.count(F.lit(1))).alias(
                "cancellation_rate_pct"
            ),
        )
    )
