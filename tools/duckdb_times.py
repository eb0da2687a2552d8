"""Time each oracle SQL in DuckDB (single node) on the same parquet tables.

Usage: python tools/duckdb_times.py [sf_dir]   → one JSON line (median of 3 runs).
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from marketlake.plans import registry  # noqa: E402
from marketlake.plans.tables import TABLES  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute("set threads = 8")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    registry.load_all()
    out = {}
    for name, sql in registry.ORACLES.items():
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            con.execute(f"select count(*) from ({sql}) q").fetchall()
            runs.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(runs), 4)
    print(json.dumps({"engine": "duckdb", "threads": 8, "sf_dir": sf, "total": round(sum(out.values()), 3),
                      "queries": out}))


if __name__ == "__main__":
    main()
