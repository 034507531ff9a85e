"""Compare registered queries with their SQL twins: ``python tests/oracle_check.py [folder] [names...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    """A value with its type name, so that 1 and 1.0 or a date and a timestamp differ."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, (int, Decimal, float)):
        return (type(value).__name__, repr(value))
    if isinstance(value, datetime):
        return ("datetime", value.isoformat())
    if isinstance(value, date):
        return ("date", value.isoformat())
    return (type(value).__name__, str(value))


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, connection, sql: str) -> tuple[int, str | None]:
    """(rows, None) if equal, else (rows, what differs first)."""
    spark_columns, spark_rows = canonical(df.columns, df.collect())
    result = connection.execute(sql)
    sql_columns, sql_rows = canonical([d[0] for d in result.description], result.fetchall())
    if spark_columns != sql_columns:
        return len(spark_rows), f"columns {spark_columns} / {sql_columns}"
    if len(spark_rows) != len(sql_rows):
        return len(spark_rows), f"rows {len(spark_rows)} / {len(sql_rows)}"
    for mine, theirs in zip(spark_rows, sql_rows):
        if mine != theirs:
            return len(spark_rows), f"{mine}\n    / {theirs}"
    return len(spark_rows), None


def main() -> int:
    import __spark_entry__ as entry
    from clearbook.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session(8)
    connection = connect(folder)
    failed = 0
    for name in names:
        started = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            sql = entry.oracle_sql().get(name)
            rows, difference = compare(df, connection, sql) if sql else (df.count(), None)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            rows, sql, difference = 0, "", f"{type(error).__name__}: {str(error)[:600]}"
        failed += difference is not None
        verdict = "DIFFERS" if difference else ("ok" if sql else "ok (rows only)")
        print(f"{verdict:15}{name:24}{rows:8} rows {time.time() - started:6.2f} s  {difference or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
