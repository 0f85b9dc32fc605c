"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python -m tests.oracle_harness [sf_dir] [key ...]
Compares row count, column names and an order-insensitive multiset of
normalised rows (floats to 6 decimals, timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) or isinstance(v, np.floating):
        if math.isnan(v):
            return None
        return round(float(v), 6)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if v is pd.NaT:
        return None
    return v


def canon(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, keys=None, verbose=True) -> dict:
    import __spark_entry__ as entry
    qs, orc = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for k in (keys or list(qs)):
        t0 = time.time()
        try:
            sp = qs[k](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            out[k] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(k, out[k]); continue
        if k not in orc:
            out[k] = f"rows-only {len(sp)}"
            if verbose:
                print(f"{k:40s} {out[k]} ({time.time()-t0:.1f}s)")
            continue
        try:
            dk = con.sql(orc[k]).df()
        except Exception as e:  # noqa: BLE001
            out[k] = f"DUCK ERROR {str(e)[:300]}"
            print(k, out[k]); continue
        res = []
        if sorted(sp.columns) != sorted(dk.columns):
            res.append(f"cols spark={sorted(sp.columns)} duck={sorted(dk.columns)}")
        if len(sp) != len(dk):
            res.append(f"rows spark={len(sp)} duck={len(dk)}")
        if not res:
            a, b = canon(sp), canon(dk)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                res.append(f"values differ e.g. {diff}")
        out[k] = "OK" if not res else "; ".join(res)
        if verbose:
            print(f"{k:40s} {out[k] if res else 'OK'} rows={len(sp)} ({time.time()-t0:.1f}s)")
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from eventide.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, keys)
    bad = {k: v for k, v in res.items() if v != "OK" and not v.startswith("rows-only")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; failing: {sorted(bad)}")
