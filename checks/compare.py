"""Compare the registered queries with their SQL: ``python -m checks.compare <folder> [names]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from collections.abc import Iterable
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import registered
from fieldpulse.session import build_session


def _rows(columns: list[str], rows: Iterable[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def differences(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides have the same columns and the same multiset of rows."""
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    expected = _rows(columns, result.fetchall())
    actual = _rows(frame.columns, (tuple(r) for r in frame.collect()))
    if actual == expected:
        return None
    surplus, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows, {sum(expected.values())} expected; "
        f"surplus {sum(surplus.values())} {list(surplus)[:2]}, "
        f"missing {sum(missing.values())} {list(missing)[:2]}"
    )


def compare(spark: SparkSession, folder: str, names: list[str]) -> int:
    connection = open_tables(folder)
    failed = 0
    queries = registered()
    for name in names or list(queries):
        began = time.time()
        difference = differences(queries[name](spark, folder), connection, ORACLES[name])
        failed += difference is not None
        print(f"{name:36s} {time.time() - began:6.2f}s {difference or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    session = build_session(
        "compare",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    sys.exit(compare(session, sys.argv[1], sys.argv[2:]) > 0)
