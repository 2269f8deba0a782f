"""Run queries beside their oracle SQL and compare the rows (`python -m workload.compare [sf] [name ...]`)."""

from __future__ import annotations

import sys
import time
from decimal import Decimal

import duckdb

from silverlode.session import build_session
from workload.oracle import FINAL, sql_for
from workload.queries import QUERIES, run

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float):
        return repr(value)
    return value


def normalized(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, folder: str, name: str) -> str | None:
    """None when both sides agree, else a short description of the first difference."""
    df = run(name, spark, folder)
    ours = normalized(df.columns, [tuple(r) for r in df.collect()])
    if name not in FINAL:
        return None if ours else "no rows"
    result = con.execute(sql_for(name))
    columns = [d[0] for d in result.description]
    theirs = normalized(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(df.columns)}\n   spark {a}\n   sql   {b}"
    return None


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "0.01"
    names = argv[1:] or list(QUERIES)
    folder = f"/root/testdata/sf{sf}"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        started = time.perf_counter()
        try:
            problem = difference(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "" if name in FINAL else " (rows only)"
        print(f"{name:26s} {time.perf_counter() - started:6.2f}s {problem or 'ok'}{kind}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
