"""Generated date and time-of-day dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_PARTS = ("NIGHT", "EARLY_MORNING", "MORNING_PEAK", "MIDDAY", "EVENING_PEAK", "EVENING",
             "LATE_NIGHT")


def dim_date(trips: DataFrame, pad_days: int = 30) -> DataFrame:
    """Every date from the first to the last request, padded on both sides."""
    requested = F.to_date("requested_at")
    bounds = trips.agg(F.min(requested).alias("first"), F.max(requested).alias("last"))
    days = bounds.where(F.col("first").isNotNull()).select(
        F.explode(
            F.sequence(
                F.date_sub("first", pad_days),
                F.date_add("last", pad_days),
                F.expr("INTERVAL 1 DAY"),
            )
        ).alias("full_date")
    )
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    return days.select(
        (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).alias("date_id"),
        "full_date",
        weekday.cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        F.month(day).cast("smallint").alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.year(day).cast("smallint").alias("year"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
    )


def day_part(hour: Column) -> Column:
    return (
        F.when(hour <= 4, "NIGHT")
        .when(hour <= 6, "EARLY_MORNING")
        .when(hour <= 9, "MORNING_PEAK")
        .when(hour <= 16, "MIDDAY")
        .when(hour <= 20, "EVENING_PEAK")
        .when(hour <= 22, "EVENING")
        .otherwise("LATE_NIGHT")
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """The 1,440 minutes of a day."""
    minutes = spark.range(1440).select(
        F.expr("cast(id div 60 as smallint)").alias("hour_24"),
        (F.col("id") % 60).cast("smallint").alias("minute"),
    )
    hour = F.col("hour_24")
    part = day_part(hour)
    return minutes.select(
        (hour * 100 + F.col("minute")).cast("int").alias("time_id"),
        "hour_24",
        "minute",
        F.format_string("%02d:%02d", "hour_24", "minute").alias("time_of_day"),
        part.alias("day_part"),
        part.isin("MORNING_PEAK", "EVENING_PEAK").alias("is_peak_hour"),
    )
