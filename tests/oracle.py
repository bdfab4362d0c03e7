"""Compare the registered queries with their reference SQL on DuckDB.

As a script: ``python tests/oracle.py SF_DIR [name ...]``.
"""

from __future__ import annotations

import datetime
import math
from pathlib import Path
import sys
import time

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _kind(value):
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, datetime.datetime):
        return "timestamp"
    return type(value).__name__


def _canonical(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_canonical(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def kinds(rows) -> list[set[str]]:
    if not rows:
        return []
    return [{_kind(v) for v in column if v is not None} for column in zip(*rows)]


def compare(spark, connection, query, sql, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    result = query(spark, sf_dir)
    columns, rows = canonical(result.columns, [tuple(row) for row in result.collect()])
    answer = connection.execute(sql)
    names = [column[0] for column in answer.description]
    names, expected = canonical(names, answer.fetchall())
    if columns != names:
        return f"columns {columns} != {names}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    for found, wanted in zip(kinds(rows), kinds(expected)):
        if found and wanted and found != wanted:
            return f"types {kinds(rows)} != {kinds(expected)}"
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(rows)} rows differ, such as {wrong[0][0]} != {wrong[0][1]}"
    return None


def main() -> None:
    import __spark_entry__ as driver
    from shelfscan.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, oracles = driver.queries(), driver.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            problem = compare(spark, connection, queries[name], oracles[name], sf_dir)
        except Exception as error:  # noqa: BLE001 - one broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}",
              flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
