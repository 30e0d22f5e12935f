"""Helpers of the corpus operators: tables written between steps, Arrow batches of whole texts."""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from kerbside.shared import shared_dir, shuffles_removed

# Bytes of text that a task holds unpacked at a time. One longer text is a slice of its own.
SLICE_BYTES = 2_000_000
# Bytes of an Arrow batch that Spark hands to Python; a single longer row is a batch of its own.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the cluster's shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kerbside-llm/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def settled(df: DataFrame, name: str, *consumed: DataFrame) -> DataFrame:
    """`stored`, and what only this write needed goes: its shuffle files, and stored tables that
    nothing reads any more. The new table takes their place, so a lost executor needs neither."""
    spark = df.sparkSession
    with shuffles_removed(spark):
        table = stored(df.select("*"), name)
    for old in consumed:
        path = spark._jvm.org.apache.hadoop.fs.Path(_paths.pop(old))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return table


@contextmanager
def received(spark: SparkSession, limit: int) -> Iterator[None]:
    """Queries that run inside hand rows to Python in batches of about `limit` bytes."""
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, str(limit))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about `limit` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        run = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64)) // limit
        starts = np.flatnonzero(np.diff(run, prepend=-1))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a missing one is empty."""
    return [t or "" for t in batch.column(column).to_pylist()]
