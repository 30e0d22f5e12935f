"""Tables written once per application to the cluster's shared folder.

Writing a table cuts lineage durably: losing executors costs a re-read, not a recompute.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Spark then deletes the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
LEAST_TASKS = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
TIMES = "spark.sql.parquet.outputTimestampType"

# Columns with about as many values as rows: a dictionary of them is given up, and built in vain.
MANY_VALUED = (
    "event_id", "causation_id", "partition_key", "correlation_id", "payload_json", "kafka_offset",
    "event_timestamp", "ingested_at", "landed_at", "trip_id", "payment_id", "requested_at",
    "accepted_at", "arrived_at", "started_at", "completed_at", "cancelled_at", "paid_at", "key",
    "value", "offset",
)

Result = TypeVar("Result")

_written: dict[tuple[str, str], str] = {}
_schemas: dict[str, T.StructType] = {}
_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`.

    Where it is unset, a session in one process (as in tests) gets a temporary folder; a cluster
    must name a folder that its executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="kerbside-")
    return _fallback[app]


def together(spark: SparkSession, *actions: Callable[[], Result]) -> list[Result]:
    """Run actions that need nothing of each other at the same time, so that one's last tasks leave
    no core idle. Their results come in order; all have ended before a failure is raised."""
    with ThreadPoolExecutor(max(len(actions), 1)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(a)) for a in actions]
    return [s.result() for s in started]


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside take their shuffle files with them."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


@contextmanager
def _writing(spark: SparkSession, writers: int = 2) -> Iterator[None]:
    """Settings of a write. A task with fewer directories than `writers` keeps a file open in each;
    from that number on Spark sorts its rows. Small shuffles are merged to a few tasks a core, not
    to one: what they feed can be many times larger, and a last task would hold up all others.
    Times are whole numbers, which cost less than the twelve bytes that Spark writes by default."""
    wanted = {WRITERS: str(writers), TIMES: "TIMESTAMP_MICROS",
              LEAST_TASKS: str(4 * spark.sparkContext.defaultParallelism)}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def written_once(
    spark: SparkSession, scope: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """The table `name` of a scope, written the first time this application asks for it.

    What only this write needed, its shuffle files, goes when it has ended.
    """
    return spark.read.parquet(_path_of(spark, scope, name, build))


def is_written(spark: SparkSession, scope: str, name: str) -> bool:
    """Whether this application has written the table `name` of a scope."""
    return _key(spark, scope, name) in _written


def written_apart(
    spark: SparkSession, scope: str, name: str, build: Callable[[], DataFrame], flag: str
) -> DataFrame:
    """`written_once`, rows with and without the boolean `flag` apart: who reads one skips the other."""
    path = _path_of(spark, scope, name, build, flag)
    # The schema is given, because directories do not tell a flag's type, and may all be missing.
    return spark.read.schema(_schemas[path]).parquet(path)


def _key(spark: SparkSession, scope: str, name: str) -> tuple[str, str]:
    app = spark.sparkContext.applicationId
    return f"{app}/{hashlib.md5(scope.encode()).hexdigest()[:12]}", name


def _path_of(
    spark: SparkSession, scope: str, name: str, build: Callable[[], DataFrame],
    flag: str | None = None,
) -> str:
    key = _key(spark, scope, name)
    if key not in _written:
        path = f"{shared_dir(spark)}/kerbside/{key[0]}/{name}"
        table = build()
        # A flag makes two directories.
        with shuffles_removed(spark), _writing(spark, 3 if flag else 2):
            # A new plan, so that the settings hold for it.
            writer = table.select("*").write.mode("overwrite").option("compression", "zstd")
            for column in MANY_VALUED:
                writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
            (writer.partitionBy(flag) if flag else writer).parquet(path)
        _written[key], _schemas[path] = path, table.schema
    return _written[key]
