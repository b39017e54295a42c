"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(folder, f"{name}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
            )
    return connection


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_as_given(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, [tuple(_plain(row[name]) for name in names) for row in df.collect()]


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names, rows = rows_as_given(df)
    return names, sorted(rows, key=_key)


def sql_as_given(connection, statement: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(statement)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]


def sql_rows(connection, statement: str) -> tuple[list[str], list[tuple], dict[str, str]]:
    result = connection.execute(statement)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    return [columns[i] for i in order], sorted(rows, key=_key), types


def difference(df: DataFrame, connection, statement: str) -> str | None:
    """What differs, or None."""
    names, rows = spark_rows(df)
    other_names, other_rows, types = sql_rows(connection, statement)
    if names != other_names:
        return f"columns {names} against {other_names}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows against {len(other_rows)}"
    for row, other in zip(rows, other_rows):
        for name, a, b in zip(names, row, other):
            if a != b or type(a) is not type(b):
                return f"{name}: {a!r} against {b!r} in {row} / {other}"
    return None


def plan_text(df: DataFrame) -> str:
    """The physical plan, with nothing cut off."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended")
    ).split("== Physical Plan ==")[1]
