"""Run registered Spark queries and their DuckDB twins side by side.

Mirrors the driver's gate: row count, column names, and an
order-insensitive hash of the values (columns sorted by name).
Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, pd.Timestamp):
        v = v.tz_localize(None) if v.tzinfo else v
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, float):
        return repr(float(v))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    return str(v)


def fingerprint(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest(), rows


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as entry
    qs, orc = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        sp = qs[name](spark, sf_dir).toPandas()
        t1 = time.time()
        if name not in orc:
            results[name] = ("rows-only", len(sp))
            if verbose:
                print(f"{name:32s} rows-only n={len(sp)} spark={t1 - t0:.2f}s")
            continue
        dk = con.execute(orc[name]).df()
        a, b = fingerprint(sp), fingerprint(dk)
        ok = a[0] == b[0] and a[1] == b[1] and a[2] == b[2]
        results[name] = ok
        if verbose:
            print(f"{name:32s} {'OK ' if ok else 'BAD'} n={a[0]}/{b[0]} spark={t1 - t0:.2f}s")
            if not ok:
                print("  cols", a[1], b[1])
                sa, sb = set(a[3]), set(b[3])
                for r in list(sa - sb)[:3]:
                    print("  spark-only", r[:300])
                for r in list(sb - sa)[:3]:
                    print("  duck-only ", r[:300])
    return results


if __name__ == "__main__":
    from pylonflow.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v is False]
    print("FAILED:", bad if bad else "none")
