"""Exact quantiles by counting values, never by sorting a group in one task.

Values are whole numbers (cents, milliseconds). Counts per value are aggregated first, then
summed in coarse bands. Only the bands that contain a wanted rank are looked at value by
value, so every window runs over bands or over the values of one band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def values_at_ranks(
    df: DataFrame,
    group: list[str],
    value: str,
    ranks: dict[str, Column],
    band: int = 1_000,
) -> DataFrame:
    """Per group, the value standing at each wanted 1-based rank in ascending order.

    `ranks` are expressions over `_total`, the group's number of non-NULL values.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_band", F.floor(F.col(value) / F.lit(band)).cast("bigint"))
    )
    bands = counts.groupBy(*group, "_band").agg(F.sum("_n").alias("_band_n"))
    by_band = Window.partitionBy(*group).orderBy("_band")
    whole = Window.partitionBy(*group)
    edges = bands.select(
        *group,
        "_band",
        F.sum("_band_n").over(by_band).alias("_upto"),
        (F.sum("_band_n").over(by_band) - F.col("_band_n")).alias("_below"),
        F.sum("_band_n").over(whole).alias("_total"),
    )
    wanted = edges.select(
        *group, "_band", "_upto", "_below", F.explode(_rank_structs(ranks)).alias("_want")
    ).where(
        (F.col("_want.rank") > F.col("_below")) & (F.col("_want.rank") <= F.col("_upto"))
    )
    in_band = Window.partitionBy(*group, "_band").orderBy(value)
    # Only the bands holding a wanted rank are ranked value by value.
    positions = counts.join(wanted.select(*group, "_band"), [*group, "_band"], "left_semi").select(
        *group,
        value,
        "_band",
        F.sum("_n").over(in_band).alias("_pos"),
        (F.sum("_n").over(in_band) - F.col("_n")).alias("_prev"),
    )
    picked = positions.join(wanted, [*group, "_band"]).where(
        (F.col("_want.rank") - F.col("_below") > F.col("_prev"))
        & (F.col("_want.rank") - F.col("_below") <= F.col("_pos"))
    )
    return picked.groupBy(*group).agg(
        *[
            F.max(F.when(F.col("_want.name") == name, F.col(value))).alias(name)
            for name in ranks
        ]
    )


def _rank_structs(ranks: dict[str, Column]) -> Column:
    return F.array(
        *[F.struct(F.lit(n).alias("name"), r.cast("bigint").alias("rank")) for n, r in ranks.items()]
    )


def exact_median(df: DataFrame, group: list[str], value: str, alias: str) -> DataFrame:
    """Median of a whole-number column: the mean of the two middle values."""
    total = F.col("_total")
    middle = values_at_ranks(
        df,
        group,
        value,
        {"_low": F.floor((total + 1) / 2), "_high": F.floor((total + 2) / 2)},
    )
    return middle.select(
        *group, ((F.col("_low") + F.col("_high")).cast("double") / F.lit(2.0)).alias(alias)
    )


def quantile_cuts(df: DataFrame, value: str, parts: int) -> DataFrame:
    """One row with cut_1 .. cut_{parts-1}: the smallest value covering each share."""
    total = F.col("_total")
    return values_at_ranks(
        df.withColumn("_all", F.lit(1)),
        ["_all"],
        value,
        {f"cut_{i}": F.ceil(total * F.lit(i) / F.lit(parts)) for i in range(1, parts)},
    ).drop("_all")
