"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python -m tests.oracle_harness [--sf DIR] [name ...]

Comparison mirrors the driver: column names (sorted), row count, and an
order-insensitive multiset of rows.  Floats are compared exactly and, when
that fails, at 9 significant digits (reported as ``approx``).
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from collections import Counter

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from courtside.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, approx: bool):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if approx:
            return float(f"{v:.9g}")
        return v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, approx) for x in v)
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of(pdf, cols, approx):
    out = Counter()
    for rec in pdf[cols].itertuples(index=False, name=None):
        out[tuple(_norm(x, approx) for x in rec)] += 1
    return out


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT"}


def compare(spark, name, query, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    sp = sdf.toPandas()
    t1 = time.time()
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    dp = rel.df()
    cols_s, cols_d = sorted(sp.columns), sorted(dp.columns)
    res = {"name": name, "spark_rows": len(sp), "oracle_rows": len(dp),
           "spark_sec": round(t1 - t0, 2)}
    if cols_s != cols_d:
        res["status"] = f"columns differ: {cols_s} vs {cols_d}"
        return res
    type_diff = {c: (t, duck_types.get(c)) for c, t in sdf.dtypes
                 if SPARK_TO_DUCK.get(t, t) != duck_types.get(c)}
    if type_diff:
        res["status"] = f"types differ: {type_diff}"
        return res
    if len(sp) != len(dp):
        res["status"] = "row count differs"
        return res
    for approx in (False, True):
        a, b = rows_of(sp, cols_s, approx), rows_of(dp, cols_s, approx)
        if a == b:
            res["status"] = "approx" if approx else "match"
            return res
    diff = list((a - b).items())[:3], list((b - a).items())[:3]
    res["status"] = f"values differ: spark-only {diff[0]} oracle-only {diff[1]}"
    return res


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain", action="store_true",
                    help="bare local[8] session with Spark defaults (as a foreign driver would use)")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    import __spark_entry__ as E
    if args.plain:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        from courtside.session import build_session
        spark = build_session("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(args.sf)
    bad = 0
    for name in (args.names or list(qs)):
        if name not in sqls:
            df = qs[name](spark, args.sf)
            print(f"{name:32s} rows-only: {df.count()} rows")
            continue
        try:
            r = compare(spark, name, qs[name], sqls[name], args.sf, con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
            bad += 1
        else:
            bad += r["status"] not in ("match", "approx")
        print(f"{name:32s} {r.get('status')}  rows={r.get('spark_rows')}/{r.get('oracle_rows')} "
              f"t={r.get('spark_sec')}s", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
