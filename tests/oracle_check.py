"""Run registered Spark queries and their DuckDB oracles side by side and compare.

usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column match, value match, seconds.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if os.environ.get("EXACT_FLOATS") else round(v, 9)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(records, cols):
    out = [tuple(norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    scols = sorted(sdf.columns)
    ts = time.time() - t
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    ok_cols = scols == sorted(dcols)
    ok_rows = len(srows) == len(drows)
    ok_vals = ok_cols and rows_of(srows, scols) == rows_of(drows, scols)
    return ok_cols, ok_rows, ok_vals, len(srows), len(drows), ts, scols, sorted(dcols), srows, drows


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from scorewright.session import local_session
    import __spark_entry__ as entry

    spark = local_session()
    con = duck(sf_dir)
    qs, os_ = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        if name not in os_:
            print(f"{name:32s} NO ORACLE")
            continue
        try:
            ok_cols, ok_rows, ok_vals, ns, nd, ts, sc, dc, srows, drows = compare(spark, con, name, qs[name], os_[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:32s} ERROR {type(e).__name__}: {str(e)[:300]}")
            continue
        flag = "OK " if (ok_cols and ok_rows and ok_vals) else "BAD"
        bad += flag == "BAD"
        print(f"{name:32s} {flag} rows {ns}/{nd} cols={ok_cols} vals={ok_vals} {ts:.1f}s")
        if flag == "BAD" and os.environ.get("SHOW_DIFF"):
            print("  spark cols", sc, "\n  duck cols ", dc)
            a, b = rows_of(srows, sc), rows_of(drows, sc) if ok_cols else []
            sa, sb = set(a), set(b)
            print("  only spark:", list(sa - sb)[:5])
            print("  only duck :", list(sb - sa)[:5])
    print("BAD", bad)


if __name__ == "__main__":
    main(sys.argv)
