"""Run every registered query against its DuckDB SQL: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, name: str, query, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = query(spark, sf_dir)
    ours = normalise(frame.columns, [tuple(r) for r in frame.collect()])
    relation = connection.execute(sql)
    theirs = normalise([c[0] for c in relation.description], relation.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    differing = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(differing)} rows differ, e.g. {differing[0]}" if differing else None


def main() -> int:
    import __spark_entry__ as spark_entry
    from tidemark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, bad = connect(sf_dir), spark_entry.oracle_sql(), 0
    for name, query in spark_entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name, query, oracles[name]) if name in oracles else "no oracle"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:32} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
