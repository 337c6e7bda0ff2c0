"""Run queries in Spark and their oracle SQL in DuckDB and compare the rows.

Usage: python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.queries import ORACLE, QUERIES
from tidemark.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark: SparkSession, sf_dir: str, name: str, connection) -> str | None:
    """What is different, or nothing."""
    frame = QUERIES[name](spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    if name not in ORACLE:
        return None if got else "no rows"
    relation = connection.execute(ORACLE[name])
    names = [column[0] for column in relation.description]
    want = rows_of(names, relation.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} are not {sorted(names)}"
    if got == want:
        return None if got else "both empty"
    extra = [row for row in got if row not in set(want)][:3]
    lacking = [row for row in want if row not in set(got)][:3]
    return f"{len(got)} rows, expected {len(want)}; only here {extra}; only there {lacking}"


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle(sf_dir)
    bad = 0
    for name in names or list(QUERIES):
        started = time.time()
        try:
            problem = differences(spark, sf_dir, name, connection)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'BAD ' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(names or QUERIES)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
