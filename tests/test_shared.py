"""What the stored layers leave on disk, and what their plans carry."""

from __future__ import annotations

import io
from contextlib import redirect_stdout
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import SF

from kerbside import shared
from kerbside.bindings.marts import Marts
from kerbside.bindings.stream_queries import raw_messages


def plan_of(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_base_and_messages_take_the_derived_landing(spark, monkeypatch):
    asked = []

    def build(session, scope, name, make):
        asked.append(name)
        return make()

    monkeypatch.setattr("kerbside.bindings.marts.written_once", build)
    monkeypatch.setattr("kerbside.bindings.stream_queries.written_once", build)
    m = Marts(spark, SF)
    assert m.base.columns and m.presence.columns and raw_messages(m).columns
    assert "landing" not in asked and "presence_landing" not in asked


def test_stored_layers_are_small_and_free_their_shuffles(spark, monkeypatch):
    seen = []

    def build():
        seen.append(spark.conf.get(shared.CLEANUP, None))
        return spark.range(1_000).selectExpr("id % 7 AS k").groupBy("k").count()

    before = spark.conf.get(shared.CLEANUP, None)
    with shared.shuffles_removed(spark):
        assert spark.conf.get(shared.CLEANUP) == "true"
    table = shared.written_once(spark, "test", "small", build)
    assert spark.conf.get(shared.CLEANUP, None) == before and seen == [before]
    assert sorted(r["count"] for r in table.collect()) == [142] + [143] * 6
    files = [Path(f.removeprefix("file://")) for f in table.inputFiles()]
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression
            for f in files} == {"ZSTD"}


def test_trips_are_grouped_without_json(marts):
    plan = plan_of(marts.build_trips())
    grouped = [part for part in plan.split("\n\n") if "Aggregate" in part.split("\n")[0]]
    assert grouped and not any("payload" in part for part in grouped)


def test_together_runs_actions_at_the_same_time(spark):
    from threading import Barrier

    from kerbside.shared import together

    both, ended = Barrier(2, timeout=60), []

    def count(n):
        both.wait()  # passes only while the other action runs
        ended.append(spark.range(n).count())
        return ended[-1]

    assert together(spark, lambda: count(3), lambda: count(5)) == [3, 5]

    def fail():
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError, match="stopped"):
        together(spark, fail, lambda: ended.append(7))
    assert ended[-1] == 7 and together(spark) == []


def test_events_are_ranked_with_a_stored_table_of_hot_trips(spark, marts, tmp_path):
    """As in a pipeline run."""
    from kerbside.operators.running import hot_keys
    from kerbside.operators.sequence import KEY, sequence_events

    base = marts.base.where("correlation_id is not null")
    for most in (5, 1_000_000):  # with hot trips and without
        hot_keys(base, KEY, most).write.parquet(f"{tmp_path}/{most}")
        hot = spark.read.parquet(f"{tmp_path}/{most}")
        assert (hot.count() > 0) == (most == 5)
        ranked = ("event_id", "event_sequence_number", "is_out_of_order")
        want = sequence_events(base).select(*ranked)
        got = sequence_events(base, hot=hot).select(*ranked)
        assert sorted(got.collect()) == sorted(want.collect())
    # Spark sees the size of the table, and shuffles no event for the joins with it.
    assert "SortMergeJoin LeftAnti" not in plan_of(sequence_events(base, hot=hot))


def test_stored_layers_keep_whole_number_times_and_no_idle_dictionaries(spark):
    rows = spark.sql("SELECT timestamp_seconds(id) AS paid_at, cast(id AS string) AS event_id, "
                     "'x' AS event_type FROM range(100)")
    table = shared.written_once(spark, "test", "times", lambda: rows)
    assert sorted(table.collect()) == sorted(rows.collect())
    files = [Path(f.removeprefix("file://")) for f in table.inputFiles()]
    for group in (pq.ParquetFile(f).metadata.row_group(0) for f in files):
        columns = {c.path_in_schema: c for c in (group.column(i) for i in range(3))}
        assert columns["paid_at"].physical_type == "INT64"
        kept = {n for n, c in columns.items() if any("DICTIONARY" in e for e in c.encodings)}
        assert kept == {"event_type"}


def test_a_flagged_write_keeps_both_directories_open(spark):
    seen = []

    def build():
        return spark.range(10, numPartitions=1).selectExpr("id", "id % 2 = 0 AS even")

    writing = shared._writing

    def spying(session, writers=2):
        seen.append(writers)
        return writing(session, writers)

    shared._writing, before = spying, shared._writing
    try:
        table = shared.written_apart(spark, "test", "open", build, "even")
    finally:
        shared._writing = before
    # Spark sorts a task's rows once it has as many directories as writers.
    assert seen == [3]
    assert {(r["id"], r["even"]) for r in table.collect()} == {(i, i % 2 == 0) for i in range(10)}


@pytest.mark.parametrize("name", ["dim_time_in_use", "supply_buckets", "run_report",
                                  "rule_trips_without_events", "hourly_curve",
                                  "rule_payment_without_completion"])
def test_what_a_query_reads_once_is_not_stored(spark, monkeypatch, name):
    from kerbside.bindings.queries import QUERIES, load

    load()
    asked = []

    def build(session, scope, table, make):
        asked.append(table)
        return make()

    want = sorted(map(str, QUERIES[name](spark, SF).collect()))
    monkeypatch.setattr("kerbside.bindings.marts.is_written", lambda *a: False)
    monkeypatch.setattr("kerbside.bindings.marts.written_once", build)
    found = QUERIES[name](spark, SF)
    assert set(asked) <= {"base_ranked", "presence"}
    # Trips are assembled in one place of the plan, and nothing is summed up by session.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate" in line and "is_attribute" in line]
    assert len(grouped) == 1 and "_l_dispatched_trips" not in plan
    assert sorted(map(str, found.collect())) == want


def test_a_stored_table_is_read_and_not_made_again(spark):
    m = Marts(spark, SF)
    _ = m.fct_trips
    assert Marts(spark, SF).once("fct_trips", "trips").inputFiles() == m.fct_trips.inputFiles()
