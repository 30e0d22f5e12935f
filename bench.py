"""Headline timings: one JSON line. Each query writes to a no-op sink after its inputs exist.

`landing` derives and stores the landing zone, `raw_messages` its message form; the other
entries read stored layers, as the matching step of a pipeline run would.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from kerbside.bindings.incremental_queries import LoadRun  # noqa: E402
from kerbside.bindings.market_queries import surge_grid_under_weather  # noqa: E402
from kerbside.bindings.marts import Marts  # noqa: E402
from kerbside.bindings.stream_queries import raw_messages  # noqa: E402
from kerbside.operators.dedup import dedup_batch  # noqa: E402
from kerbside.plans import marketplace, metrics  # noqa: E402
from kerbside.session import build_session  # noqa: E402
from kerbside.streaming.validation import split, validate  # noqa: E402


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Warm the JVM on a small table of its own.
    noop(spark.range(1_000_000).selectExpr("id % 1000 AS k").groupBy("k").count())
    m = Marts(spark, sf_dir)
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.time()
        run()
        seconds[name] = round(time.time() - start, 3)

    timed("landing", lambda: (m.landing, m.presence_landing))
    timed("raw_messages", lambda: raw_messages(m))
    timed("ingest_validate_dedup",
          lambda: noop(dedup_batch(split(validate(raw_messages(m)))[0])))
    timed("base_dedup", lambda: noop(m.build_base()))
    m.base, m.presence
    timed("trips_assembled", lambda: noop(m.build_trips()))
    m.trips
    timed("sessions_assembled", lambda: noop(m.build_sessions()))
    m.sessions
    for fact in ("fct_trips", "fct_payments", "fct_driver_sessions", "fct_trip_events"):
        timed(fact, lambda f=fact: noop(getattr(m, f"build_{f}")()))
        getattr(m, fact)
    facts = m.named("fct_trips", "fct_payments", "fct_driver_sessions", "dim_date")
    for query in (metrics.conversion_funnel, metrics.marketplace_health,
                  metrics.pricing_effectiveness, metrics.financial_truth,
                  metrics.surge_by_fare_quantile, metrics.driver_productivity):
        timed(query.__name__, lambda q=query: noop(q(facts)))
    timed("fct_pipeline_quality", lambda: noop(m.build_fct_pipeline_quality()))
    timed("anomaly_profile", lambda: noop(marketplace.anomaly_profile(m.landing)))

    timed("surge_grid", lambda: noop(surge_grid_under_weather(m)))
    loads = LoadRun(m)
    timed("first_load", loads.first)
    timed("incremental_run", loads.next)

    events = raw_messages(m).count()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus),
        "messages": events,
        "ingest_messages_per_sec": round(events / seconds["ingest_validate_dedup"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
