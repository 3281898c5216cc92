"""Compare registered queries with their DuckDB oracle SQL.

Mirrors the correctness gate: same row count, same column names, and the
same multiset of rows (columns compared by name, rows order-insensitive,
floats compared exactly through their shortest repr).

    python tests/oracle_check.py [/root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "T" if v else "F"
    if isinstance(v, float):
        if v != v:
            return "NaN"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    out = {"name": name, "rows": len(s_rows), "spark_s": round(t_spark, 3)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"COLUMNS spark={s_cols} oracle={d_cols}"
        return out
    if len(s_rows) != len(d_rows):
        out["status"] = f"ROWCOUNT spark={len(s_rows)} oracle={len(d_rows)}"
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    a = sorted(tuple(canon(r[i]) for i in si) for r in s_rows)
    b = sorted(tuple(canon(r[i]) for i in di) for r in d_rows)
    if a == b:
        out["status"] = "OK"
    else:
        diffs = [(x, y) for x, y in zip(a, b) if x != y]
        out["status"] = f"VALUES {len(diffs)} differ; first: {diffs[:2]} cols={order}"
    return out


def main(argv: list[str]) -> int:
    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            names.append(a)
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(queries):
        try:
            res = compare(spark, con, name, queries[name], oracle.get(name), sf_dir)
        except Exception as exc:  # report and continue
            res = {"name": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        bad += res["status"] not in ("OK", "rows-only")
        print(res, flush=True)
    print(f"{len(names or queries) - bad} ok, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
