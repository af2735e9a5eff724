"""Run registered Spark queries next to their DuckDB oracle and compare
row count, column names and an order-insensitive value multiset.

Usage: python tests/oracle_check.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con.execute(sql).df()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].astype(object).itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple("" if x is None else x for x in r))


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> dict:
    res = {
        "rows_spark": len(spark_df), "rows_oracle": len(oracle_df),
        "columns_match": sorted(spark_df.columns) == sorted(oracle_df.columns),
    }
    res["rows_match"] = res["rows_spark"] == res["rows_oracle"]
    if res["columns_match"]:
        a, b = rows_of(spark_df), rows_of(oracle_df)
        res["values_match"] = a == b
        if not res["values_match"]:
            cols = sorted(spark_df.columns)
            diffs = []
            for ra, rb in zip(a, b):
                if ra != rb:
                    diffs.append({c: (x, y) for c, x, y in zip(cols, ra, rb) if x != y})
                    if len(diffs) >= 3:
                        break
            res["first_diffs"] = diffs
    else:
        res["values_match"] = False
        res["only_spark"] = sorted(set(spark_df.columns) - set(oracle_df.columns))
        res["only_oracle"] = sorted(set(oracle_df.columns) - set(spark_df.columns))
    return res


def check(spark, names: list[str], sf_dir: str, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    out = {}
    for name in names:
        t = time.time()
        sdf = qs[name](spark, sf_dir).toPandas()
        t_spark = time.time() - t
        if name not in sqls:
            out[name] = {"rows_spark": len(sdf), "oracle": None}
        else:
            odf = duck(sqls[name], sf_dir)
            out[name] = compare(sdf, odf)
        out[name]["spark_sec"] = round(t_spark, 2)
        if verbose:
            print(name, out[name], flush=True)
    return out


if __name__ == "__main__":
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from footfall.session import get_spark
    import __spark_entry__ as entry

    spark = get_spark(master="local[8]")
    names = args.names or list(entry.queries())
    res = check(spark, names, f"/root/testdata/sf{args.sf}")
    bad = [n for n, r in res.items() if r.get("oracle", True) is not None and not r.get("values_match")]
    print("FAILED:", bad)
    print(f"{len(res) - len(bad)}/{len(res)} ok")
