"""Mixing sources to target weights by Poisson replication.

A source's weight and its number of documents give a mean repetition rate. Each document draws
its number of copies by inverting the Poisson distribution of that mean at a hash of its id, so
the draw repeats on any cluster and in any order. Copies get a random key each and are dealt out
and sorted by it.

Defined cases: sources without a weight of their own, and missing sources, share the weight
`others` as one source; a weighted source without documents gets nothing and its share goes to
the rest; a weight of zero drops its documents; rows repeated under one id draw alike; a missing
id draws as the text 'null'; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHERS = "*"
HEX_DIGITS = 13  # 52 bits, exact as a double


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the MD5 of a text."""
    return F.conv(F.substring(F.md5(key), 1, HEX_DIGITS), 16, 10).cast("double") / F.lit(
        float(16**HEX_DIGITS)
    )


def rates(docs: DataFrame, weights: dict[str, float], others: float, size: float) -> DataFrame:
    """(bucket, docs, rate): one row per weighted source and one for all others.

    `size` is the expected number of copies over the number of documents. At most
    len(weights) + 1 rows, whatever the corpus.
    """
    if any(w < 0 or not math.isfinite(w) for w in [*weights.values(), others]):
        raise ValueError("weights must be finite and not negative")
    counts = docs.groupBy(_bucket(F.col("source"), weights).alias("bucket")).agg(
        F.count(F.lit(1)).alias("docs"))
    weight = F.coalesce(F.element_at(_weights(weights), F.col("bucket")), F.lit(float(others)))
    weighted = counts.select("bucket", "docs", weight.alias("weight"))
    totals = weighted.agg(F.sum("docs").alias("all_docs"), F.sum("weight").alias("all_weight"))
    # One row: the sum over the few rows above.
    return weighted.join(F.broadcast(totals)).select(
        "bucket", "docs",
        F.coalesce(
            F.try_divide(F.col("weight") * F.col("all_docs") * F.lit(float(size)),
                         F.col("all_weight") * F.col("docs")), F.lit(0.0),
        ).alias("rate"),
    )


def _weights(weights: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in {OTHERS: None, **weights}.items() for x in pair]
                        ).cast("map<string,double>")


def _bucket(source: Column, weights: dict[str, float]) -> Column:
    return F.when(source.isin(list(weights)), source).otherwise(F.lit(OTHERS))


def _thresholds(rates_: DataFrame) -> DataFrame:
    """(bucket, rate, steps): the Poisson distribution function at 0, 1, 2, ... until it is 1."""
    far = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    log_terms = F.transform(
        F.sequence(F.lit(0), far),
        lambda k: F.when(k == 0, F.lit(0.0)).otherwise(F.ln(F.col("rate") / k)),
    )
    # Terms in logarithms, because exp(-rate) alone would vanish for large rates.
    listed = rates_.where("rate > 0").select("bucket", "rate", F.posexplode(log_terms))
    in_order = "PARTITION BY bucket ORDER BY pos"
    return (
        listed.selectExpr("bucket", "rate", "pos", f"sum(col) OVER ({in_order}) - rate AS ln_p")
        .selectExpr("bucket", "rate", "pos", f"sum(exp(ln_p)) OVER ({in_order}) AS cdf")
        .groupBy("bucket", "rate").agg(F.array_sort(F.collect_list("cdf")).alias("steps"))
    )


def mix(
    docs: DataFrame, weights: dict[str, float], others: float = 1.0, size: float = 1.0,
    seed: str = "mix",
) -> DataFrame:
    """(row, source_rate, copy, shuffle_key): the copies of every row, dealt out at random.

    `row` is the input row as a struct. Partitions come from a hash of the random key and are
    sorted by it, so reading them in order is a random order of the whole mixture.
    """
    # At most len(weights) + 1 rows: a proven bound for the broadcast.
    table = F.broadcast(_thresholds(rates(docs, weights, others, size)))
    name = F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null"))
    drawn = (
        docs.select(F.struct("*").alias("row"), _bucket(F.col("source"), weights).alias("bucket"))
        .join(table, "bucket")
        .withColumn("u", uniform(F.concat(F.lit(f"{seed}:"), name)))
        .select("row", "rate", F.size(F.filter("steps", lambda c: c <= F.col("u"))).alias("n"))
        .where("n > 0")
    )
    copies = drawn.select(
        "row", F.col("rate").alias("source_rate"),
        F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"),
    ).withColumn("shuffle_key", F.xxhash64(F.lit(seed), "copy", name))
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
