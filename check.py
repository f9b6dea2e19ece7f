"""Run registered queries next to their SQL and compare the rows.

    python check.py [-d DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import importlib
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("-d", "--dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = (
        SparkSession.builder.master(f"local[{os.cpu_count()}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.log.level", "ERROR")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.dir}/{t}.parquet'")
    entry = importlib.import_module("__spark_entry__")
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        start = time.time()
        try:
            df = fn(spark, args.dir)
            cols = sorted(df.columns)
            got = sorted(tuple(cell(r[c]) for c in cols) for r in df.collect())
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: {str(e)[:1500]}")
            continue
        took = time.time() - start
        if name not in oracle:
            print(f"rows {name}: {len(got)} rows {took:.1f}s")
            continue
        try:
            rel = con.execute(oracle[name])
            names = [d[0] for d in rel.description]
            types = {d[0]: str(d[1]) for d in rel.description}
            rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: oracle: {str(e)[:1500]}")
            continue
        order = sorted(range(len(names)), key=lambda i: names[i])
        want = sorted(tuple(cell(r[i]) for i in order) for r in rows)
        same_type = {
            "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
        }
        diff_types = [(c, t, types.get(c)) for c, t in df.dtypes if same_type.get(t, t) != types.get(c)]
        if cols != sorted(names):
            bad += 1
            print(f"FAIL {name}: columns {cols} against {sorted(names)}")
        elif got != want:
            bad += 1
            only_got = [r for r in got if r not in set(want)][:3]
            only_want = [r for r in want if r not in set(got)][:3]
            print(f"FAIL {name}: {len(got)} rows against {len(want)}\n  columns {cols}\n  spark {only_got}\n  sql   {only_want}")
        else:
            print(f"ok   {name}: {len(got)} rows {took:.1f}s" + (f"  TYPES {diff_types}" if diff_types else "") + ("  EMPTY" if not got else ""))
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
