"""Side-by-side run of a registered query and its SQL; also usable from the command line:
``python -m tests.oracle [name ...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

from statloom.workload.tables import TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def connect(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: [(x is not None, str(type(x)), x) for x in r])


def compare(spark, con, name, fn, sql, sf_dir=SF_DIR) -> str | None:
    """None when equal, otherwise what differs."""
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return None
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    if a != b:
        first = next((x, y) for x, y in zip(a, b, strict=True) if x != y)
        return f"values differ: {first}"
    same = {
        "INTEGER": "int",
        "BIGINT": "bigint",
        "SMALLINT": "smallint",
        "VARCHAR": "string",
        "DOUBLE": "double",
        "BOOLEAN": "boolean",
        "DATE": "date",
        "TIMESTAMP": "timestamp_ntz",
    }
    found = dict(df.dtypes)
    off = {n: (found[n], t) for n, t in types.items() if same.get(t, t) != found[n]}
    return f"types {off}" if off else None


def main() -> None:
    import __spark_entry__ as e
    from statloom.session import local_session

    spark = local_session("oracle", 8)
    con = connect()
    names = sys.argv[1:] or list(e.queries())
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, e.queries()[name], e.oracle_sql().get(name))
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        mark = "ok" if problem is None else "DIFF"
        note = "" if name in e.oracle_sql() else " (rows only)"
        print(f"{mark:5}{name}{note} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} differ")


if __name__ == "__main__":
    main()
