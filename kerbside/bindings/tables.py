"""DataFrames over the driver's tables, and the landing zone derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.bindings.landing_sql import landing_ctes, landing_select
from kerbside.schemas import LANDING, PRESENCE, TRIPS
from kerbside.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, zone-less times read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    zoneless = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when the input has fewer splits than the session has slots."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def derived_landing(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    """Landing rows of one event family derived from orders, lineitem and customer."""
    configure(spark)
    views = {}
    for name in ("orders", "lineitem", "customer"):
        views[name] = f"kerbside_{name}"
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        if name == "orders":
            df = spread(df)
        df.createOrReplaceTempView(views[name])
    prefix = {TRIPS: "trip", PRESENCE: "presence"}[family]
    rows = spark.sql(f"WITH {landing_ctes('spark', views)} {landing_select(prefix)}")
    return rows.withColumn("topic", F.lit(family)).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in LANDING]
    )
