"""Run catalog queries next to their SQL in DuckDB: python tests/compare.py [table folder] [query ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "conversations")


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows as sorted text tuples, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value: object) -> str:
        if value is None:
            return "∅"
        if isinstance(value, float):
            return repr(value + 0.0)
        return str(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def differences(spark, connection, build, sql: str, sf_dir: str) -> tuple[int, list[str]]:
    """Number of rows, and what differs."""
    df = build(spark, sf_dir)
    mine = canonical(df.columns, [tuple(row) for row in df.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = canonical(names, cursor.fetchall())
    found = []
    if sorted(df.columns) != sorted(names):
        found.append(f"columns {sorted(df.columns)} / {sorted(names)}")
    if len(mine) != len(theirs):
        found.append(f"rows {len(mine)} / {len(theirs)}")
    if mine != theirs:
        a, b = set(mine), set(theirs)
        found.append(f"only here {sorted(a - b)[:2]}; only there {sorted(b - a)[:2]}; {len(a - b)} differ")
    return len(mine), found


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from kerbline import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("compare", "local[8]", conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = open_tables(sf_dir), oracle_sql()
    for name, build in queries().items():
        if names and name not in names:
            continue
        started = time.perf_counter()
        try:
            if name in sql:
                rows, found = differences(spark, connection, build, sql[name], sf_dir)
            else:
                rows, found = build(spark, sf_dir).count(), []
            state = "; ".join(found) if found else ("ok" if name in sql else "ran")
        except Exception as error:  # a broken query must not hide the others
            rows, state = 0, f"ERROR {str(error)[:600]}"
        print(f"{name:26} {rows:7} {time.perf_counter() - started:6.2f}s  {state}", flush=True)


if __name__ == "__main__":
    main()
