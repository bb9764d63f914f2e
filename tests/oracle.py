"""Compare a Spark query with its SQL in DuckDB on the same Parquet tables.

As a program: ``python -m tests.oracle [folder] [query…]``.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark and DuckDB names of the same types
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark_df, connection, sql: str) -> str | None:
    """None if both give the same columns, types and rows, else what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = _rows(names, result.fetchall())
    actual_rows = spark_df.collect()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"
    for field in spark_df.schema:
        wanted = TYPE_NAMES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if types[field.name] != wanted:
            return f"{field.name} is {wanted} instead of {types[field.name]}"
    actual = _rows(spark_df.columns, [tuple(r) for r in actual_rows])
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(expected)} rows differ, first {wrong[0][0]} instead of {wrong[0][1]}"
    return None if expected else "no rows on either side"


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry_points
    from earshot import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles = entry_points.oracle_sql()
    bad = 0
    for name, query in entry_points.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            if name in oracles:
                problem = difference(query(spark, folder), connect(folder), oracles[name])
            else:
                problem = None if query(spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001  (reported below)
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "ok" if name in oracles else "ok (rows only)"
        print(f"{name:40s} {time.time() - started:6.1f}s  {problem or kind}", flush=True)
    print(f"{bad} wrong")


if __name__ == "__main__":
    main()
