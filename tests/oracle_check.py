"""Local stand-in for the driver's correctness check.

Runs a registered Spark query and its DuckDB oracle on the same parquet
tables and compares row count, column names and an order-insensitive hash of
the values.  Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
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
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else None
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return str(v.tolist())
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return v


def table_hash(cols: list[str], rows) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    digests = sorted(
        hashlib.sha1(repr(tuple(_norm(r[i]) for i in order)).encode()).hexdigest() for r in rows
    )
    return len(digests), hashlib.sha1("".join(digests).encode()).hexdigest()


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        res = {"spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
        if name in sqls:
            cur = con.execute(sqls[name])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
            res["oracle_rows"] = len(d_rows)
            res["oracle_sec"] = round(time.time() - t1, 2)
            res["cols_match"] = sorted(s_cols) == sorted(d_cols)
            res["match"] = res["cols_match"] and table_hash(s_cols, s_rows) == table_hash(d_cols, d_rows)
            if not res["match"] and verbose:
                _diff(name, s_cols, s_rows, d_cols, d_rows)
        out[name] = res
        if verbose:
            print(name, res, flush=True)
    return out


def _diff(name, s_cols, s_rows, d_cols, d_rows, limit=5):
    if sorted(s_cols) != sorted(d_cols):
        print(f"  [{name}] columns spark={s_cols} oracle={d_cols}")
        return
    order_s = [s_cols.index(c) for c in sorted(s_cols)]
    order_d = [d_cols.index(c) for c in sorted(d_cols)]
    ss = {tuple(_norm(r[i]) for i in order_s) for r in s_rows}
    dd = {tuple(_norm(r[i]) for i in order_d) for r in d_rows}
    print(f"  [{name}] cols={sorted(s_cols)}")
    for r in list(ss - dd)[:limit]:
        print("   spark-only ", r)
    for r in list(dd - ss)[:limit]:
        print("   oracle-only", r)


if __name__ == "__main__":
    from ledgerlens.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    r = compare(spark, sf, names)
    bad = [k for k, v in r.items() if v.get("match") is False]
    print("MISMATCH:", bad if bad else "none")
