"""Run registered queries on both engines and compare: python -m checks.compare SF_DIR [name ...]."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

from checks.context import Context
from checks.registry import registered
from earshot.session import local_session

ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations")


def plain(value):
    if value is None:
        return "~"
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "~" if math.isnan(value) else repr(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def connect(sf_dir):
    con = duckdb.connect()
    for name in ALL_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def kind(name: str) -> str:
    name = name.lower()
    for group in (("bigint", "long", "int64", "hugeint"), ("int", "integer", "int32"), ("double", "float"), ("string", "varchar"),
                  ("boolean", "bool"), ("timestamp_ntz", "timestamp"), ("date",)):
        if name in group:
            return group[0]
    return name


def compare(ctx, con, name, fn, sql):
    start = time.time()
    df = fn(ctx)
    got = df.collect()
    took = time.time() - start
    mine, columns = rows_of(df.columns, got)
    if sql is None:
        return "rows", len(mine), took, ""
    result = con.execute(sql)
    theirs, names = rows_of([d[0] for d in result.description], result.fetchall())
    if columns != names:
        return "COLUMNS", len(mine), took, f"{columns} / {names}"
    types = {d[0]: kind(str(d[1])) for d in result.description}
    odd = {n: (kind(t), types[n]) for n, t in df.dtypes if kind(t) != types[n]}
    if mine != theirs:
        a, b = set(mine), set(theirs)
        return "VALUES", len(mine), took, f"{len(mine)}/{len(theirs)} only spark {sorted(a - b)[:3]} only duck {sorted(b - a)[:3]}"
    return ("types" if odd else "ok"), len(mine), took, str(odd or "")


def main(argv):
    sf_dir, names = argv[0], argv[1:]
    spark, con = local_session(), connect(sf_dir)
    ctx, bad = Context.of(spark, sf_dir), 0
    for name, (fn, sql) in registered().items():
        if names and name not in names and not any(n.endswith("*") and name.startswith(n[:-1]) for n in names):
            continue
        try:
            status, n, took, note = compare(ctx, con, name, fn, sql)
        except Exception as e:  # noqa: BLE001 - report and go on
            status, n, took, note = "ERROR", 0, 0.0, f"{type(e).__name__}: {str(e)[:600]}"
        bad += status not in ("ok", "rows")
        print(f"{name:28s} {status:8s} {n:7d} {took:6.2f}s {note}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
