"""Compare each registered Spark query with its DuckDB oracle.

Usage: ``python tests/oracle_check.py [sf_dir] [key ...]``.  Prints one line
per key and exits non-zero when any key differs.  Comparison: same column
names, same row count, and the same multiset of rows (values compared exactly,
columns in name order), like the driver's order-insensitive value hash.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(float(v)))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    return (3, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), sorted(columns)


# Spark simple type name -> DuckDB type name of the same values
SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE",
}


def type_diffs(sdf, res) -> list[str]:
    duck_types = {d[0]: str(d[1]).upper() for d in res.description}
    out = []
    for name, t in sdf.dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        got = duck_types.get(name)
        if got is not None and got != want:
            out.append(f"{name}: spark {t} duckdb {got}")
    return out


def compare(spark, con, key: str, fn, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    s_sorted, s_cols = rows_of(df.columns, srows)
    if sql is None:
        return True, f"rows-only ({len(srows)} rows, spark {t1 - t0:.2f}s)"
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    d_sorted, d_cols = rows_of(dcols, drows)
    if s_cols != d_cols:
        return False, f"columns differ: spark {s_cols} duckdb {d_cols}"
    tdiff = type_diffs(df, res)
    if tdiff:
        return False, f"types differ: {tdiff}"
    if len(srows) != len(drows):
        return False, f"row count spark {len(srows)} duckdb {len(drows)}"
    if s_sorted != d_sorted:
        diff = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:3]
        return False, f"values differ ({len(srows)} rows), first: {diff}"
    return True, f"{len(srows)} rows, spark {t1 - t0:.2f}s"


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from quarry.config import session
    import __spark_entry__ as entry

    spark = session(8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        try:
            ok, msg = compare(spark, con, k, qs[k], sqls.get(k), sf_dir)
        except Exception as e:  # report and go on with the next key
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {k}: {msg}", flush=True)
    print(f"{len(keys or qs) - bad}/{len(keys or qs)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
