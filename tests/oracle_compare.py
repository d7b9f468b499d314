"""Run a registered Spark query and its DuckDB oracle SQL, compare results.

Order-insensitive: rows are normalised to strings (floats rounded, dates and
timestamps in ISO form, decimals as numbers), columns sorted by name.
Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NaT:
            return None
    except Exception:  # pragma: no cover
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{round(float(v), 6):.6f}"
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "to_pydatetime"):
        return _norm(v.to_pydatetime())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.6f}" if abs(v) < 2**53 else str(v)
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    out.sort(key=lambda t: tuple("" if x is None else x for x in t))
    return [columns[i].lower() for i in order], out


def compare(spark, name, build, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = build(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    ok = sc == dc and sr == dr
    info = {"name": name, "ok": ok, "spark_rows": len(sr), "oracle_rows": len(dr),
            "cols_equal": sc == dc, "sec": round(t1 - t0, 2)}
    if not ok:
        info["spark_cols"], info["oracle_cols"] = sc, dc
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        info["only_spark"], info["only_oracle"] = diff_s, diff_d
    return info


def main(argv):
    import __spark_entry__ as entry
    from dimsmith.session import get_spark

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_spark()
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        if name not in oracle:
            df = qs[name](spark, sf_dir)
            print({"name": name, "rows_only": df.count()})
            continue
        try:
            info = compare(spark, name, qs[name], oracle[name], sf_dir, con)
        except Exception as exc:  # noqa: BLE001
            info = {"name": name, "ok": False, "error": repr(exc)[:600]}
        bad += not info["ok"]
        print(info, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
