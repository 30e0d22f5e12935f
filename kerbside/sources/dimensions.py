"""Typed reference dimensions, from CSV or from the bundled members."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.sources.reference_data import DIMENSION_TYPES, values_sql


def load_dimension(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """One dimension with declared types.

    Without a path the bundled members come back as a literal relation: Catalyst knows its
    exact size, so joins to it are broadcast without a hint. With a path, typed CSV is read
    and the optimizer decides by file size.
    """
    if path is None:
        return spark.sql(values_sql(name))
    return (
        spark.read.schema(DIMENSION_TYPES[name])
        .option("header", True)
        .option("enforceSchema", False)
        .csv(f"{path.rstrip('/')}/{name}.csv")
    )


def load_dimensions(spark: SparkSession, path: str | None = None) -> dict[str, DataFrame]:
    return {name: load_dimension(spark, name, path) for name in DIMENSION_TYPES}


def city_zones(dims: dict[str, DataFrame]) -> DataFrame:
    """City id and time zone only, for local-time conversion."""
    return dims["dim_city"].select("city_id", F.col("timezone").alias("city_timezone"))
