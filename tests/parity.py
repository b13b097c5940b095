"""Compare registered queries with their SQL counterparts, values and all.

Run as a script for a table of outcomes and times:
``python -m tests.parity <folder> [query ...]``
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

import __spark_entry__ as entry_points


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_normal(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


def compare(spark, con, folder: str, name: str) -> tuple[str, int, float]:
    """Outcome (``match``, or what differs), row count, seconds of the Spark side."""
    started = time.time()
    df = entry_points.queries()[name](spark, folder)
    found = [tuple(r) for r in df.collect()]
    took = time.time() - started
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return ("rows only", len(found), took)
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    types = {d[0]: str(d[1]) for d in answer.description}
    expected = answer.fetchall()
    if sorted(columns) != sorted(df.columns):
        return (f"columns {sorted(df.columns)} != {sorted(columns)}", len(found), took)
    mine = dict(df.dtypes)
    odd = {
        c: (mine[c], t)
        for c, t in types.items()
        if mine[c] not in _SAME.get(t, (t.lower(),))
    }
    if odd:
        return (f"types {odd}", len(found), took)
    a, b = _rows(df.columns, found), _rows(columns, expected)
    if a != b:
        left = [r for r in a if r not in b[:5000]][:2]
        right = [r for r in b if r not in a[:5000]][:2]
        return (f"values {len(a)} vs {len(b)}: {left} | {right}", len(found), took)
    return ("match", len(found), took)


_SAME = {
    "VARCHAR": ("string",),
    "BIGINT": ("bigint",),
    "INTEGER": ("int",),
    "DOUBLE": ("double",),
    "BOOLEAN": ("boolean",),
    "TIMESTAMP": ("timestamp_ntz",),
    "DATE": ("date",),
}


if __name__ == "__main__":
    from starlane.session import local_session

    session = local_session("parity")
    source = sys.argv[1]
    connection = connect(source)
    bad = 0
    for query in sys.argv[2:] or list(entry_points.queries()):
        try:
            outcome, rows, seconds = compare(session, connection, source, query)
        except Exception as error:  # noqa: BLE001
            outcome, rows, seconds = f"ERROR {type(error).__name__}: {str(error)[:600]}", -1, 0.0
        bad += outcome not in ("match", "rows only")
        print(f"{query:32} {rows:7} {seconds:6.2f}s  {outcome}", flush=True)
    print(f"{bad} differ")
