"""Run registered queries against their DuckDB counterparts and report differences.

Usage: python tests/compare.py <sf_dir> [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(value):
    """Numbers compare by value, everything else by type and text."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimal reached the output")
    if isinstance(value, float):
        return ("f", value + 0.0)
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple(cell(r[i]) for i in order) for r in rows
    )


def compare(spark, con, run, sql, sf_dir):
    """None when equal, else a description of the difference."""
    df = run(spark, sf_dir)
    got_names, got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns: only spark {set(got_names) - set(want_names)}, only sql {set(want_names) - set(got_names)}"
    if got == want:
        return None if sum(got.values()) else "both empty"
    extra, missing = list((got - want).elements()), list((want - got).elements())
    detail = ""
    if extra and missing:
        a = min(extra, key=str)
        b = min(missing, key=lambda r: sum(x != y for x, y in zip(a, r)))
        detail = str([(n, x, y) for n, x, y in zip(got_names, a, b) if x != y])
    elif extra or missing:
        detail = str((extra or missing)[0])
    return f"{sum(got.values())} vs {sum(want.values())} rows, {len(extra)} extra, {len(missing)} missing; {detail[:600]}"


def main() -> int:
    import __spark_entry__ as entry
    from kerbside.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, run, oracle[name], sf_dir)
            else:
                problem = None if run(spark, sf_dir).collect() else "no rows"
        except Exception as exc:  # report every query
            problem = f"{type(exc).__name__}: {str(exc)[:900]}"
        failed += problem is not None
        tag = "ok  " if problem is None else "FAIL"
        kind = "" if name in oracle else " (rows only)"
        print(f"{tag} {name}{kind} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
