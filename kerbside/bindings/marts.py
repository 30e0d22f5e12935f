"""Every table of the pipeline over the driver's tables.

As in a production run, each layer is written once and the next layer reads it: the landing
zone, the deduplicated base, assembled trips and sessions, the facts. A `build_*` method
computes one layer from the stored layer below it. The landing zone is itself derived from the
driver's tables, so the base takes the derived rows and only queries about the landing store it.
A query that reads a table once takes it into its own plan, unless the table is stored already.
"""

from __future__ import annotations

from copy import copy
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kerbside.bindings.tables import derived_landing
from kerbside.operators.assembly import assemble_sessions, quarantined, trips_from_base
from kerbside.operators.dedup import REPEATS, dedup_keep_first
from kerbside.operators.staging import base_events, marked_events, typed_events
from kerbside.plans import calendar, facts, quality
from kerbside.schemas import PRESENCE, PRESENCE_EVENT_TYPES, TRIPS
from kerbside.session import configure
from kerbside.shared import is_written, written_apart, written_once
from kerbside.sources.dimensions import load_dimensions

STORED = ("landing", "presence_landing", "presence", "trips", "sessions", "fct_trips",
          "fct_payments", "fct_driver_sessions", "fct_trip_events")


class Marts:
    """Pipeline tables by attribute; `stored=False` keeps everything one lazy plan."""

    def __init__(self, spark: SparkSession, sf_dir: str, stored: bool = True):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.stored = stored

    def __getattr__(self, name: str):
        if name.startswith("build_") or f"build_{name}" not in dir(type(self)):
            raise AttributeError(name)
        build = getattr(self, f"build_{name}")
        if self.stored and name in STORED:
            table = written_once(self.spark, self.sf_dir, name, build)
        else:
            table = build()
        self.__dict__[name] = table
        return table

    def once(self, name: str, *below: str) -> DataFrame:
        """A table for a query that reads it once, and the tables `below` (lowest last) for no more.

        The stored one where there is one. Else all of it is part of the query's plan, and columns
        that nothing reads are not written to be left unread.
        """
        if name in self.__dict__ or (self.stored and is_written(self.spark, self.sf_dir, name)):
            return getattr(self, name)
        apart = copy(self)
        for table in reversed(below):
            apart.__dict__[table] = apart.once(table)
        return getattr(apart, f"build_{name}")()

    @cached_property
    def base(self) -> DataFrame:
        """The deduplicated base. Stored, it is made of rows without copies, which are written
        where they are read, and of the others, ranked."""
        if not self.stored:
            return self.build_base()
        marked = written_apart(self.spark, self.sf_dir, "base_marked",
                               lambda: marked_events(self.build_landing()), REPEATS)
        ranked = written_once(self.spark, self.sf_dir, "base_ranked", lambda: dedup_keep_first(
            marked.where(REPEATS).drop(REPEATS)))
        return marked.where(f"NOT {REPEATS}").drop(REPEATS).unionByName(ranked)

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return load_dimensions(self.spark)

    def typed(self, event_type: str) -> DataFrame:
        source = self.presence if event_type in PRESENCE_EVENT_TYPES else self.base
        return typed_events(source, event_type)

    def named(self, *wanted: str) -> dict[str, DataFrame]:
        """The named marts plus all dimensions."""
        return {
            **self.dims,
            "dim_time": self.dim_time,
            **{name: getattr(self, name) for name in wanted},
        }

    def named_once(self, **wanted: tuple[str, ...]) -> dict[str, DataFrame]:
        """`named` for marts that are read once, each with the tables below it."""
        return self.named() | {name: self.once(name, *below) for name, below in wanted.items()}

    def build_landing(self) -> DataFrame:
        return derived_landing(self.spark, self.sf_dir, TRIPS)

    def build_presence_landing(self) -> DataFrame:
        return derived_landing(self.spark, self.sf_dir, PRESENCE)

    def build_base(self) -> DataFrame:
        return base_events(self.build_landing())

    def build_presence(self) -> DataFrame:
        return base_events(self.build_presence_landing())

    def build_trips(self) -> DataFrame:
        return trips_from_base(self.base)

    def build_sessions(self) -> DataFrame:
        return assemble_sessions(
            self.typed("DriverOnline"), self.typed("DriverOffline"), self.trips
        )

    def build_fct_trips(self) -> DataFrame:
        return facts.fct_trips(self.trips, self.dims)

    def build_fct_payments(self) -> DataFrame:
        return facts.fct_payments(self.base, self.dims, self.trips)

    def build_fct_driver_sessions(self) -> DataFrame:
        return facts.fct_driver_sessions(self.sessions, self.dims)

    def build_fct_trip_events(self) -> DataFrame:
        return facts.fct_trip_events(self.base, self.dims)

    def build_dim_date(self) -> DataFrame:
        return calendar.dim_date(self.trips)

    def build_dim_time(self) -> DataFrame:
        return calendar.dim_time(self.spark)

    def build_quarantined_trips(self) -> DataFrame:
        return quarantined(self.fct_trips)

    def build_fct_pipeline_quality(self) -> DataFrame:
        return quality.pipeline_quality(
            self.base, self.presence, self.fct_trips, self.fct_payments, self.fct_driver_sessions
        )


def plain(df: DataFrame) -> DataFrame:
    """Column types both engines print alike: double, bigint, zone-less timestamps."""

    def cast(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return f"cast({name} AS double) AS {name}"
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return f"cast({name} AS bigint) AS {name}"
        if isinstance(field.dataType, T.TimestampType):
            return f"cast({name} AS timestamp_ntz) AS {name}"
        return name

    return df.selectExpr(*[cast(f) for f in df.schema])


