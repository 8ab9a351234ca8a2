"""Single-node comparison: DuckDB (the reference's engine) running the oracle SQL of the
bench's headline queries on the same parquet tables. Prints one JSON line."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from oracle_check import duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402

sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
con = duck(sf)
sqls = E.oracle_sql()
out = {}
for name in bench.HEADLINE:
    if name not in sqls:
        continue
    con.sql(sqls[name]).fetchall()
    s = []
    for _ in range(3):
        t0 = time.perf_counter()
        con.sql(sqls[name]).fetchall()
        s.append(time.perf_counter() - t0)
    out[name] = round(statistics.median(s), 4)
print(json.dumps({"engine": "duckdb", "sf_dir": sf, "queries": out, "sum": round(sum(out.values()), 3)}))
