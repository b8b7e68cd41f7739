"""Run the registered queries next to their SQL and print what differs.

Usage: python tests/check_oracles.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry_point

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, int):
        return float(value)
    return str(value)


def normalised(columns: list[str], rows: list[tuple]) -> list[tuple]:
    places = sorted(range(len(columns)), key=lambda place: columns[place])
    plain = [tuple(_plain(row[place]) for place in places) for row in rows]
    return sorted(plain, key=repr)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def compare(spark: SparkSession, connection, folder: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = entry_point.queries()[name](spark, folder)
    ours = normalised(frame.columns, [tuple(row) for row in frame.collect()])
    cursor = connection.execute(entry_point.oracle_sql()[name])
    columns = [item[0] for item in cursor.description]
    theirs = normalised(columns, cursor.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns differ: {sorted(set(frame.columns) ^ set(columns))}"
    if ours == theirs:
        return None
    only_ours, only_theirs = sorted(set(ours) - set(theirs), key=repr), sorted(set(theirs) - set(ours), key=repr)
    return f"{len(ours)} rows against {len(theirs)}; {len(only_ours)} differ\n  {sorted(columns)}\n  spark {only_ours[:3]}\n  sql   {only_theirs[:3]}"


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("ledgerloom-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = session(), connect(folder)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in sys.argv[2:] or entry_point.oracle_sql():
        started = time.time()
        try:
            difference = compare(spark, connection, folder, name)
        except Exception as error:  # report and go on to the next query
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += difference is not None
        print(f"{'ok  ' if difference is None else 'BAD '} {name} {time.time() - started:.2f}s {difference or ''}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or entry_point.oracle_sql())} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
