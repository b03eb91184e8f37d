"""Side-by-side check: each catalogue query in Spark vs its DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares column names, row counts and the multiset of rows (exact values).
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v if v is None else (repr(v) if not isinstance(v, str) else v)


def compare(spark, sf_dir, names=None, plans=None):
    """name -> outcome; ``plans`` gets each query's physical plan as text, as it was before it ran."""
    from rillflow.plans.catalog import ORACLES, QUERIES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    results = {}
    for name in names or sorted(QUERIES):
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir)
            scols = sdf.columns
            if plans is not None:
                plans[name] = sdf._jdf.queryExecution().executedPlan().toString()
            srows = [tuple(row) for row in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        if name not in ORACLES:
            results[name] = f"no oracle ({len(srows)} rows) {time.time() - t0:.1f}s"
            continue
        try:
            rel = con.sql(ORACLES[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {str(e)[:300]}"
            continue
        if sorted(scols) != sorted(dcols):
            results[name] = f"COLUMNS differ spark={sorted(scols)} duck={sorted(dcols)}"
            continue
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        s = sorted((tuple(_norm(row[i]) for i in si) for row in srows), key=repr)
        d = sorted((tuple(_norm(row[i]) for i in di) for row in drows), key=repr)
        if len(s) != len(d):
            results[name] = f"ROWS differ spark={len(s)} duck={len(d)}"
        elif s != d:
            diff = [(a, b) for a, b in zip(s, d) if a != b][:3]
            results[name] = f"VALUES differ ({sum(1 for a, b in zip(s, d) if a != b)} rows) e.g. {diff} cols={order}"
        else:
            results[name] = f"ok ({len(s)} rows) {time.time() - t0:.1f}s"
    return results


if __name__ == "__main__":
    from rillflow.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    res = compare(spark, sf, sys.argv[2:] or None)
    for k, v in res.items():
        print(f"{k:32s} {v}")
    bad = [k for k, v in res.items() if not v.startswith(("ok", "no oracle"))]
    print("FAILED:", bad)
