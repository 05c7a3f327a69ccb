"""Run registered Spark queries and their DuckDB oracle side by side.

Mirrors the driver's check: row count, column names (sorted) and an
order-insensitive comparison of the values.  Usage::

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bramble.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 4)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    ok_n = len(srows) == len(drows)
    ok_v = ok_cols and rows_of(scols, srows) == rows_of(dcols, drows)
    status = "OK " if (ok_cols and ok_n and ok_v) else "BAD"
    print(f"{status} {name:40s} rows {len(srows)}/{len(drows)} cols={ok_cols} vals={ok_v} spark {t1 - t0:.1f}s")
    if status == "BAD":
        print("   spark cols", scols, "\n   duck  cols", dcols)
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        diff_a = [r for r in a if r not in b][:5]
        diff_b = [r for r in b if r not in a][:5]
        print("   only spark:", diff_a, "\n   only duck:", diff_b)
    return status == "OK "


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as entry
    from bramble.session import local_session

    if os.environ.get("ORACLE_PLAIN_SESSION"):
        # The driver's own session: no checkpoint folder, default codegen limits.
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROW {name:40s} rows {n} (no oracle) spark {time.time() - t0:.1f}s")
            continue
        try:
            if not compare(spark, con, name, fn, sqls[name], sf_dir):
                bad.append(name)
        except Exception as e:  # report and go on
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:400]}")
            bad.append(name)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
