"""Compare registered queries with their SQL in DuckDB.

    python -m shelfwise.checks.run <tables> [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from shelfwise.checks.oracles import ORACLES
from shelfwise.checks.queries import QUERIES
from shelfwise.session import get_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(root: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return connection


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    fixed = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(fixed, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def compare(spark, connection, root: str, name: str) -> str | None:
    """None if the two results are equal, else what differs."""
    frame = QUERIES[name](spark, root)
    spark_rows = _rows(frame.columns, frame.collect())
    if name not in ORACLES:
        return None if spark_rows else "no rows"
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    duck_rows = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows against {len(duck_rows)}"
    different = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    types = [(a, b) for a, b in zip(spark_rows, duck_rows) if [type(v) for v in a] != [type(v) for v in b]]
    if different:
        return f"{len(different)} rows differ, e.g. {different[0]}"
    return f"types differ, e.g. {types[0]}" if types else None


def main(root: str, names: list[str]) -> int:
    spark = get_session("checks", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(root)
    failures = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, connection, root, name)
        except Exception as error:  # report every query, not just the first that fails
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
        failures += bool(problem)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
