"""Run a registered query on Spark and its SQL on DuckDB and compare all values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for name in TABLES:
        path = os.path.join(directory, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences between both engines; an empty list means they agree exactly."""
    cursor = con.execute(sql)
    sql_names = [d[0] for d in cursor.description]
    sql_types = {d[0]: str(d[1]) for d in cursor.description}
    sql_rows = cursor.fetchall()
    names = sorted(spark_df.columns)
    if names != sorted(sql_names):
        return [f"columns differ: {names} / {sorted(sql_names)}"]
    table = spark_df.select(*[f"`{n}`" for n in names]).toArrow()
    columns = [table.column(i).to_pylist() for i in range(len(names))]
    left = _sorted([tuple(_plain(v) for v in row) for row in zip(*columns)])
    index = [sql_names.index(n) for n in names]
    right = _sorted([tuple(_plain(row[i]) for i in index) for row in sql_rows])
    problems = []
    expected = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for field in spark_df.schema.fields:
        kind = expected.get(field.dataType.simpleString())
        if kind and sql_types[field.name] != kind:
            problems.append(f"type of {field.name}: {kind} / {sql_types[field.name]}")
    if len(left) != len(right):
        problems.append(f"row counts differ: {len(left)} / {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} of {len(left)} rows differ, first {names}: {wrong[0]}")
    if not left:
        problems.append("no rows")
    return problems
