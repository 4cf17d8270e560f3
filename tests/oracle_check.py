"""Compare queries with their SQL twins: columns, types, rows.

Run as a script: ``python tests/oracle_check.py [folder] [query ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def kind(type_name: str) -> str:
    """Common names for the types of both engines."""
    names = {"bigint": "long", "integer": "int", "varchar": "string", "timestamp_ntz": "timestamp"}
    return names.get(type_name.lower(), type_name.lower())


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def compare(df, connection, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    result = connection.execute(sql)
    theirs = {d[0]: i for i, d in enumerate(result.description)}
    their_kinds = {d[0]: kind(str(d[1])) for d in result.description}
    their_rows = result.fetchall()
    our_kinds = {n: {"bigint": "long"}.get(t, t) for n, t in df.dtypes}
    our_kinds = {n: kind(t) for n, t in our_kinds.items()}
    columns = sorted(our_kinds)
    if columns != sorted(theirs):
        return f"columns {columns} and {sorted(theirs)}"
    if our_kinds != their_kinds:
        odd = {c: (our_kinds[c], their_kinds[c]) for c in columns if our_kinds[c] != their_kinds[c]}
        return f"types {odd}"
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    others = sorted((tuple(plain(r[theirs[c]]) for c in columns) for r in their_rows), key=key)
    if len(ours) != len(others):
        return f"{len(ours)} and {len(others)} rows"
    odd = [(a, b) for a, b in zip(ours, others) if a != b]
    if odd:
        return f"{len(odd)} of {len(ours)} rows, first {odd[:2]} in {columns}"
    return None if ours else "no rows"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tallyworks.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = queries()[name](spark, folder)
            sql = oracle_sql().get(name)
            problem = compare(df, connection, sql) if sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.1f}s  {problem or 'equal'}", flush=True)
    print("different:", bad, "of", len(wanted))


if __name__ == "__main__":
    main()
