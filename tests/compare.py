"""Run a registered query in Spark and its oracle in DuckDB; compare.

Mirrors the driver's gate: column names, row count and an order-insensitive
hash of the values.  ``python tests/compare.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import hashlib
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, float):
        return repr(round(v, 6))
    if hasattr(v, "asDict"):
        return _norm(list(v))
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [cols[i] for i in order], len(lines), h, lines


def duck(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, key: str, sf_dir: str, verbose: bool = True):
    import __spark_entry__ as E

    t0 = time.time()
    df = E.queries()[key](spark, sf_dir)
    srows = df.collect()
    scols = df.columns
    t1 = time.time()
    osql = E.oracle_sql().get(key)
    if osql is None:
        return {"key": key, "rows": len(srows), "oracle": None, "spark_s": round(t1 - t0, 2)}
    dcols, drows = duck(osql, sf_dir)
    t2 = time.time()
    sc, sn, sh, sl = digest(scols, srows)
    dc, dn, dh, dl = digest(dcols, drows)
    ok = sc == dc and sn == dn and sh == dh
    res = {"key": key, "ok": ok, "rows": sn, "oracle_rows": dn, "cols": sc == dc,
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if not ok and verbose:
        res["spark_cols"], res["duck_cols"] = sc, dc
        a, b = set(sl), set(dl)
        res["only_spark"] = sorted(a - b)[:3]
        res["only_duck"] = sorted(b - a)[:3]
    return res


def main(argv):
    from sitelens.session import get_spark

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import os

    spark = get_spark(shuffle_partitions=8, driver_memory=os.environ.get("COMPARE_DRIVER_MEMORY", "8g"))
    import __spark_entry__ as E

    keys = argv[2:] or list(E.queries())
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir)
        except Exception as e:  # report and go on
            r = {"key": k, "ok": False, "error": repr(e)[:800]}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
