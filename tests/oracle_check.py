"""Side-by-side check of queries() against oracle_sql() on DuckDB (like the driver's gate).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402

from vaultline.sources.testdata import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, (np.bool_, bool)):
        return bool(v)
    if isinstance(v, (np.integer, int)):
        return int(v)
    if isinstance(v, (decimal.Decimal, np.floating, float)):
        f = float(v)
        return None if math.isnan(f) else round(f, 6) + 0.0
    if isinstance(v, (pd.Timestamp, dt.datetime, np.datetime64)):
        return str(pd.Timestamp(v))
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    out.sort(key=repr)
    return cols, out


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            spdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = f"rows-only {len(spdf)}"
            continue
        try:
            odf = con.sql(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        sc, sr = _rows(spdf)
        oc, orows = _rows(odf)
        if sc != oc:
            results[name] = f"COLUMNS spark={sc} oracle={oc}"
        elif len(sr) != len(orows):
            results[name] = f"ROWCOUNT spark={len(sr)} oracle={len(orows)}"
        elif sr != orows:
            diff = [(a, b) for a, b in zip(sr, orows) if a != b][:2]
            results[name] = f"VALUES differ e.g. {diff}"
        else:
            results[name] = f"OK {len(sr)} rows ({t1 - t0:.1f}s)"
        if verbose:
            print(f"{name:32s} {results[name]}", flush=True)
    return results


if __name__ == "__main__":
    from vaultline.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("OK") or v.startswith("rows-only"))}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok")
    for k, v in bad.items():
        print("FAIL", k, v)
