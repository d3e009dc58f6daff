"""Spark-vs-DuckDB comparison in the driver's style: same column names, same row count, same
multiset of rows (columns sorted by name, doubles compared after rounding)."""

from __future__ import annotations

import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duckdb_conn(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{round(v, 6):.6f}")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (3, str(v))
    return (4, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = True) -> dict:
    import __spark_entry__ as e

    con = con or duckdb_conn(sf_dir)
    t0 = time.time()
    sdf = e.queries()[name](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = e.oracle_sql().get(name)
    if sql is None:
        out["oracle"] = None
        return out
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    out["columns_match"] = sorted(sdf.columns) == sorted(d_cols)
    out["match"] = out["columns_match"] and rows_of(sdf.columns, s_rows) == rows_of(d_cols, d_rows)
    if verbose and not out["match"]:
        a, b = rows_of(sdf.columns, s_rows), rows_of(d_cols, d_rows)
        print(name, "spark cols", sdf.columns, "oracle cols", d_cols)
        diff_a = [r for r in a if r not in set(b)][:5]
        diff_b = [r for r in b if r not in set(a)][:5]
        print(" spark-only", diff_a)
        print(" oracle-only", diff_b)
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from segrec.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    import __spark_entry__ as e

    con = duckdb_conn(sf)
    for n in names or list(e.queries()):
        try:
            print(compare(spark, n, sf, con), flush=True)
        except Exception as exc:  # report and go on
            print({"name": n, "error": repr(exc)[:800]}, flush=True)
