"""Runs every named query next to its SQL on DuckDB and compares the results.

    python -m tests.oracle [folder] [name ...]    (name "sql" stands for all queries that have SQL)
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("f", "nan")
        if v == int(v) and abs(v) < 1e15:
            return ("i", int(v))
        return ("f", repr(v))
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, date):
        return ("t", datetime(v.year, v.month, v.day).isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", str([plain(x) for x in v]))
    return ("n", "") if v is None else ("s", str(v))


def canonical(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(str(tuple(plain(r[i]) for i in order)) for r in records)


def kinds(types: dict[str, str]) -> dict[str, str]:
    names = {"TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int", "tinyint": "int", "smallint": "int",
             "int": "int", "bigint": "int", "DOUBLE": "double", "double": "double", "VARCHAR": "text", "string": "text",
             "DATE": "date", "date": "date", "TIMESTAMP": "ts", "timestamp": "ts", "timestamp_ntz": "ts", "BOOLEAN": "bool", "boolean": "bool"}
    return {k: names.get(v, v) for k, v in types.items()}


def compare(spark, con, folder, name, fn, sql):
    """Returns (message or '', seconds, rows)."""
    start = time.time()
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    if sql is None:
        return "", seconds, len(got)
    cur = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in cur.description}
    a = canonical(df.columns, got)
    b = canonical(list(want_types), cur.fetchall())
    if a[0] != b[0]:
        return f"columns {a[0]} != {b[0]}", seconds, len(got)
    ka, kb = kinds(dict(df.dtypes)), kinds(want_types)
    bad = {k: (ka[k], kb[k]) for k in ka if ka[k] != kb[k]}
    note = f"types {bad}" if bad else ""
    if len(a[1]) != len(b[1]):
        return f"rows {len(a[1])} != {len(b[1])} {note}", seconds, len(got)
    diff = [(x, y) for x, y in zip(a[1], b[1]) if x != y]
    if diff:
        return f"{len(diff)} of {len(a[1])} rows differ, e.g.\n   {diff[0][0]}\n   {diff[0][1]} {note}", seconds, len(got)
    return note, seconds, len(got)


def main(argv):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as entry
    from tallyloom.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = local_session("oracle", 8), connect(folder)
    sqls, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if argv[1:] and name not in argv[1:] and not ("sql" in argv[1:] and name in sqls):
            continue
        spark.catalog.clearCache()
        try:
            message, seconds, n = compare(spark, con, folder, name, fn, sqls.get(name))
        except Exception as e:  # report and go on
            message, seconds, n = f"{type(e).__name__}: {str(e)[:1500]}", 0.0, -1
        failed += bool(message)
        kind = "oracle" if name in sqls else "rows"
        print(f"{'FAIL' if message else 'ok':4} {name:28} {kind:6} {n:7} rows {seconds:6.2f}s {message}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
