"""Time the oracle SQL (the reference's query shapes) on single-node DuckDB.

    python tools/duckdb_yardstick.py [sf_dir]

The reference publishes no timings and its engine cannot be run here, so
Prints one JSON line like bench.py.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from adlens.plans.oracle import ORACLE  # noqa: E402

TABLES = ("events",)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"set threads = {os.environ.get('BENCH_CPUS', '8')}")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    timings = {}
    for name, sql in ORACLE.items():
        t0 = time.perf_counter()
        con.execute(sql).fetchall()
        timings[name] = round(time.perf_counter() - t0, 4)
    print(json.dumps({"metric": "total_query_time", "engine": "duckdb " + duckdb.__version__,
                      "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf_dir": sf_dir}))


if __name__ == "__main__":
    main()
