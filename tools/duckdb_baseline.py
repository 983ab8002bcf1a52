"""Time the oracle SQL of every query in DuckDB (single node), median of N.

Each run reads the Parquet tables and writes a temporary table, as Spark's
runs write to a sink; no rows become Python objects.

    python tools/duckdb_baseline.py [sf_dir] [reps]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare_oracle import TABLES  # noqa: E402


def main() -> None:
    import duckdb
    from sql_oracle import oracle_sql

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    reps = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    out = {}
    for name, sql in oracle_sql().items():
        ts = []
        for _ in range(max(1, reps)):
            con.execute("DROP TABLE IF EXISTS answer")
            t0 = time.perf_counter()
            con.execute(f"CREATE TEMP TABLE answer AS {sql}")
            ts.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(ts), 3)
    print(json.dumps({"engine": "duckdb " + duckdb.__version__, "threads": con.execute(
        "SELECT current_setting('threads')").fetchone()[0], "sf_dir": sf_dir,
        "total": round(sum(out.values()), 3), "queries": out}))


if __name__ == "__main__":
    main()
