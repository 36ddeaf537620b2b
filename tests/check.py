"""Runs registered queries next to their SQL on DuckDB. ``python -m tests.check [data] [name ...]``"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(data: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None if both sides hold the same rows, else what differs."""
    left = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    right = _rows([c[0] for c in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None


def main() -> None:
    import __spark_entry__ as entry

    from millrace.session import local_session

    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(8), duck(data)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        t = time.time()
        try:
            df = fn(spark, data)
            problem = compare(df, con, oracles[name]) if name in oracles else (None if df.collect() else "no rows")
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:800]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - t:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
