"""Reconciliation of tables by sums of hashes per key bucket, without reading their history.

A side of a comparison is a set of rows, each a key and its values. Its state is, for every
bucket of keys, the number of rows and the sum of their hashes. Sums add and subtract, so a run
keeps a side's state by the rows it replaces and the rows it writes. Two sides agree where their
buckets agree; rows are only compared in buckets that differ. Sums are exact decimals of 64-bit
hashes, so that sides of equal sums and different rows are as rare as equal 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4_096


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def state(rows: DataFrame, side: str, key: str, values: Sequence[str] = (),
          buckets: int = BUCKETS) -> DataFrame:
    """(side, bucket, rows, total) of distinct (key, values); rows without a key are left out.

    Values are hashed as text, so equal numbers of different scale need one type on both sides.
    """
    cells = [F.coalesce(F.col(v).cast("string"), F.lit("\u0000")) for v in values]
    each = rows.where(F.col(key).isNotNull()).select(key, *values).distinct()
    return each.groupBy(bucket_of(key, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(key, *cells).cast("decimal(38,0)")).alias("total"),
    ).select(F.lit(side).alias("side"), "bucket", "rows", "total")


def merged(added: Sequence[DataFrame], removed: Sequence[DataFrame] = ()) -> DataFrame:
    """The state of a side after rows came and went; their keys must not overlap."""
    parts = [*added, *(r.withColumns({"rows": -F.col("rows"), "total": -F.col("total")})
                       for r in removed)]
    return (
        reduce(DataFrame.unionByName, parts).groupBy("side", "bucket")
        .agg(F.sum("rows").alias("rows"), F.sum("total").cast("decimal(38,0)").alias("total"))
        .where((F.col("rows") != 0) | (F.col("total") != 0))
    )


def differing(states: DataFrame, left: str, right: str) -> DataFrame:
    """(bucket): buckets in which two sides do not hold the same rows."""
    def sums(side: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col(name))), F.lit(0))

    return states.where(F.col("side").isin(left, right)).groupBy("bucket").agg(
        (sums(left, "rows") == sums(right, "rows")).alias("_rows"),
        (sums(left, "total") == sums(right, "total")).alias("_total"),
    ).where(~F.col("_rows") | ~F.col("_total")).select("bucket")


def only_in(rows: DataFrame, key: str, wanted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows whose key lies in one of the wanted buckets (at most `buckets` numbers)."""
    numbers = [r[0] for r in wanted.collect()]
    if not numbers:
        return rows.limit(0)
    return rows.where(bucket_of(key, buckets).isin(numbers))
