"""Differential check: each registered Spark query vs its DuckDB oracle SQL.

    python tests/oracle_check.py [sf_dir] [query ...]

Compares column names, row counts and the sorted multiset of rows (exact,
after the normalisation both sides apply).  Exit status 1 on any mismatch.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _key(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        return (2, f"{float(v):.9g}")
    return (3, str(v))


def rows_of(records, cols):
    return sorted(tuple(_key(r[c]) for c in cols) for r in records)


def compare(spark, con, name, fn, sql, sf_dir, verbose=True):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = [dict(zip(dcols, r)) for r in rel.fetchall()]
    t2 = time.time()
    scols = sdf.columns
    ok = True
    msg = []
    if sorted(scols) != sorted(dcols):
        ok = False
        msg.append(f"columns differ: spark-only {set(scols)-set(dcols)} oracle-only {set(dcols)-set(scols)}")
    elif len(srows) != len(drows):
        ok = False
        msg.append(f"rows {len(srows)} vs {len(drows)}")
    if ok:
        cols = sorted(scols)
        a, b = rows_of(srows, cols), rows_of(drows, cols)
        if a != b:
            ok = False
            diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
            for x, y in diffs:
                bad = [c for c, u, v in zip(cols, x, y) if u != v]
                msg.append(f"first diff cols {bad}: spark {[u for c,u,v in zip(cols,x,y) if u!=v]} "
                           f"oracle {[v for c,u,v in zip(cols,x,y) if u!=v]}")
    if verbose:
        print(f"{'OK ' if ok else 'BAD'} {name:28s} rows={len(srows):7d} spark={t1-t0:6.1f}s "
              f"duck={t2-t1:5.1f}s {'; '.join(msg)}", flush=True)
    return ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    from ratify.session import local_session
    import __spark_entry__ as entry
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        if name not in sqls:
            print(f"--  {name:28s} (no oracle)")
            continue
        try:
            if not compare(spark, con, name, fn, sqls[name], sf_dir):
                bad += 1
        except Exception as e:  # report and continue with the next query
            bad += 1
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:800]}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
