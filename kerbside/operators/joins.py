"""Join shapes the models share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import unknown_key


Role = tuple[str, DataFrame, str, str]


def lookup_keys(
    fact: DataFrame, roles: dict[str, Role], keep: Sequence[str] | None = None
) -> DataFrame:
    """Resolve natural keys to surrogates; a miss or NULL becomes -1, no row is lost.

    `roles` maps the new column to (fact column, dimension, code column, id column). One
    dimension may play several roles. `keep` names the fact's columns in the result (default: all).
    They pass the joins as one struct, which a join copies as it is, not column by column.
    """
    kept = [c for c in (fact.columns if keep is None else keep) if c not in roles]
    joined = fact.select(
        F.struct(*kept).alias("_row"),
        *[F.col(code).alias(f"_key_{alias}") for alias, (code, _, _, _) in roles.items()],
    )
    for alias, (_, dim, dim_code, dim_id) in roles.items():
        members = dim.selectExpr(f"{dim_code} AS _code_{alias}", f"{dim_id} AS _id_{alias}")
        joined = joined.join(members, F.col(f"_key_{alias}") == F.col(f"_code_{alias}"), "left")
    return joined.select("_row.*", *[unknown_key(F.col(f"_id_{a}")).alias(a) for a in roles])


def lookup_key(
    fact: DataFrame, dim: DataFrame, code: str, dim_code: str, dim_id: str, alias: str
) -> DataFrame:
    """Resolve one natural key."""
    return lookup_keys(fact, {alias: (code, dim, dim_code, dim_id)})


def drill_across(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join two aggregates on their whole grain.

    The right side is reduced to one row per key or the query fails, so a forgotten grain
    column raises an error instead of multiplying measures.
    """
    measures = [c for c in right.columns if c not in keys]
    unique = right.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.first(m).alias(m) for m in measures]
    )
    guard = F.when(
        F.col("_copies") > 1,
        F.raise_error(F.lit(f"drill-across: right side repeats {', '.join(keys)}")).cast("bigint"),
    ).otherwise(F.col("_copies"))
    checked = unique.withColumn("_copies", guard).where("_copies = 1").drop("_copies")
    return left.join(checked, list(keys), "left")


def keys_only(df: DataFrame, keys: DataFrame, on: str, present: bool = True) -> DataFrame:
    """Rows whose key is (or is not) in another table. NULL keys never match."""
    return df.join(keys.select(on), on, "left_semi" if present else "left_anti")


def key_difference(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Keys on one side only, with the side; each row with a NULL key is reported."""
    left_keys, right_keys = left.select(on).distinct(), right.select(on).distinct()
    missing = left_keys.where(F.col(on).isNotNull()).join(right_keys, on, "left_anti")
    extra = right_keys.where(F.col(on).isNotNull()).join(left_keys, on, "left_anti")
    nulls = left.where(F.col(on).isNull()).select(on)
    return (
        missing.withColumn("issue", F.lit("missing_from_right"))
        .unionByName(extra.withColumn("issue", F.lit("not_in_left")))
        .unionByName(nulls.withColumn("issue", F.lit("null_key")))
        .select("issue", on)
    )
