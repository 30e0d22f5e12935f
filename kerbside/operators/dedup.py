"""Removing redelivered copies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Offsets repeat across partitions, so topic and partition take part in the tie-break.
ARRIVAL_ORDER = ("ingested_at", "kafka_offset", "kafka_topic", "kafka_partition")
MESSAGE_ORDER = ("kafka_topic", "kafka_partition", "kafka_offset")

# Key hashes meet in this many words of 64 bits, whatever the number of keys: what is broadcast
# stays below 100 MB.
_WORDS = 1 << 20
REPEATS = "_repeats"


def dedup_keep_first(
    df: DataFrame,
    key: Sequence[str] = ("event_id",),
    order: Sequence[str] = ARRIVAL_ORDER,
) -> DataFrame:
    """Keep the first copy per key over the whole history.

    The `rank = 1` filter lets Spark keep only the leading row per key on the map side
    before the shuffle, so a key with very many copies does not reach one task.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return (
        df.withColumn("_arrival_rank", F.row_number().over(window))
        .where(F.col("_arrival_rank") == 1)
        .drop("_arrival_rank")
    )


def mark_repeated(
    df: DataFrame, key: Sequence[str] = ("event_id",), mark: str = REPEATS
) -> DataFrame:
    """Add a flag: false for rows whose key no other row has, true for all that may have copies.

    Hashes of keys are counted, and those that repeat set three bits of a word; a row that misses
    one of its three is alone. Many repeated keys set more bits, so that more rows are flagged, by
    the third power of the share of bits set. `df` is read twice, the first time for its key only,
    and no row is shuffled whole.
    """
    hashed = F.xxhash64(*key)
    repeated = df.select(hashed.alias("_h")).groupBy("_h").agg(
        F.count(F.lit(1)).alias("_n")).where("_n > 1")
    bits = repeated.groupBy(F.pmod("_h", F.lit(_WORDS)).alias("_word")).agg(
        F.bit_or(_mask(F.col("_h"))).alias("_bits"))
    mask = _mask(hashed)
    met = F.coalesce(F.col("_bits"), F.lit(0)).bitwiseAND(mask) == mask
    return df.join(F.broadcast(bits), F.pmod(hashed, F.lit(_WORDS)) == F.col("_word"), "left").select(
        *df.columns, met.alias(mark))


def _mask(hashed: Column) -> Column:
    """The hash's bits of its word, by its three highest groups of six bits."""
    places = [F.shiftrightunsigned(hashed, shift).bitwiseAND(63).cast("int")
              for shift in (58, 52, 46)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places]
    return reduce(Column.bitwiseOR, bits)


def dedup_batch(df: DataFrame) -> DataFrame:
    """Drop copies inside one micro-batch; the lowest topic, partition, offset wins."""
    return dedup_keep_first(df, ("event_id",), MESSAGE_ORDER)


def dedup_stream(
    df: DataFrame, key: Sequence[str] = ("event_id",), watermark: str = "7 days"
) -> DataFrame:
    """Drop copies across micro-batches inside the accepted lateness.

    An optimisation only: `dedup_keep_first` over the landing zone stays authoritative.
    """
    return df.withWatermark("ingested_at", watermark).dropDuplicatesWithinWatermark(list(key))


def duplicate_stats(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows, distinct keys and surplus copies, exact.

    Copies are counted per key first, so both shuffles carry partial counts only.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count(key).alias("distinct_ids"),
    ).withColumn("duplicates", F.col("rows") - F.col("distinct_ids"))
