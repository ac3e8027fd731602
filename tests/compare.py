"""Run a registered query and its SQL on the same tables and compare rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def sql_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def difference(spark, connection, build, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    frame = build(spark, sf_dir)
    names = sorted(frame.columns)
    found = Counter(tuple(row) for row in frame.select(*(f"`{n}`" for n in names)).collect())
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != names:
        return f"columns: spark {names}, sql {sorted(columns)}"
    order = [columns.index(n) for n in names]
    expected = Counter(tuple(row[k] for k in order) for row in cursor.fetchall())
    if found == expected:
        return None
    extra, missing = list((found - expected).items())[:2], list((expected - found).items())[:2]
    return f"rows: spark {found.total()}, sql {expected.total()}; only spark {extra}; only sql {missing}"


if __name__ == "__main__":
    from oracles.queries import oracle_sql
    from orderloom.registry import queries
    from orderloom.session import local_session

    spark, sf_dir, only = local_session("8"), f"/root/testdata/{sys.argv[1]}", sys.argv[2:]
    connection, sql = sql_connection(sf_dir), oracle_sql()
    bad = 0
    for name, build in queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            if name in sql:
                problem = difference(spark, connection, build, sql[name], sf_dir)
            else:
                problem = None if build(spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{name:45s} {time.time() - started:6.2f}s {'ok' if problem is None else 'DIFF ' + problem}", flush=True)
    print(f"{bad} differing")
