"""Registry of runnable queries and, where one exists, their SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import cube as source

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_BASES = {
    "grid": source.SQL_GRID,
    "cube": source.SQL_CUBE,
    "roles": source.SQL_ROLES,
    "cells": source.SQL_CELLS,
}


def with_sql(body: str, *bases: str, recursive: bool = False) -> str:
    """Prefix ``body`` (further CTEs and the final SELECT) with the shared tables."""
    needed = ["grid", *[b for b in bases if b != "grid"]] if bases else []
    parts = [_BASES[b] for b in needed]
    head = "WITH RECURSIVE " if recursive else "WITH "
    body = body.strip()
    if not parts:
        return body
    if body.upper().startswith("SELECT"):
        return head + ",\n".join(parts) + "\n" + body
    return head + ",\n".join(parts) + ",\n" + body


def plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT and reals as DOUBLE, so both engines show one schema."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.FloatType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, *bases: str, recursive: bool = False):
    """Register a function ``(spark, directory) -> DataFrame`` under ``name``."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        @wraps(function)
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return plain_types(function(spark, directory))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_sql(sql, *bases, recursive=recursive)
        return function

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})
