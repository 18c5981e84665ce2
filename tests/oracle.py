"""Run registered queries beside their SQL: ``python -m tests.oracle <sf> [query ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

from registry import load_all
from tinta.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
DATA = "/root/testdata"
KINDS = {
    "bigint": {"BIGINT", "HUGEINT"},
    "int": {"INTEGER"},
    "string": {"VARCHAR"},
    "double": {"DOUBLE"},
    "float": {"FLOAT"},
    "boolean": {"BOOLEAN"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _normal(value):
    if isinstance(value, float):
        return repr(0.0 if value == 0 else value)
    return repr(value)


def compare(spark, connection, name: str, folder: str) -> list[str]:
    """Differences between the Spark rows and the SQL rows; empty when they agree."""
    entry = load_all()[name]
    start = time.time()
    df = entry.run(spark, folder)
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    print(f"[spark {time.time() - start:.1f}s]", end=" ")
    if entry.sql is None:
        return [] if rows else ["no rows"]
    relation = connection.sql(entry.sql())
    if sorted(relation.columns) != columns:
        return [f"columns {columns} against {sorted(relation.columns)}"]
    types = dict(zip(relation.columns, map(str, relation.types)))
    problems = [
        f"type of {c}: {t} against {types[c]}"
        for c, t in df.dtypes
        if t in KINDS and types[c] not in KINDS[t]
    ]
    order = [relation.columns.index(c) for c in columns]
    expected = sorted(tuple(_normal(row[i]) for i in order) for row in relation.fetchall())
    found = sorted(tuple(_normal(v) for v in row) for row in rows)
    if len(found) != len(expected):
        problems.append(f"{len(found)} rows against {len(expected)}")
    different = [(f, e) for f, e in zip(found, expected) if f != e]
    if different:
        problems.append(f"{len(different)} rows differ, first {str(different[0])[:1500]}")
    return problems


def main() -> None:
    scale, *names = sys.argv[1:]
    folder = f"{DATA}/{scale}"
    spark = build_session("oracle", "local[8]", 8, {"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in names or load_all():
        start = time.time()
        try:
            problems = compare(spark, connection, name, folder)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        kind = "sql " if load_all()[name].sql else "rows"
        print(f"{'ok  ' if not problems else 'FAIL'} {kind} {time.time() - start:6.1f}s {name}", *problems, flush=True)
        failed += bool(problems)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main()
