"""Rows and plans of Spark results, and their comparison with the SQL twins."""

import contextlib
import io
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(
            f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')"
        )
    return connection


def sql_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 12)
    return value


def canonical(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    ordered = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(ordered, key=repr)


def difference(spark_result, oracle_result, shown: int = 3) -> str | None:
    """None when equal, else a short description."""
    spark_names, spark_rows = canonical(*spark_result)
    oracle_names, oracle_rows = canonical(*oracle_result)
    if spark_names != oracle_names:
        return f"columns {spark_names} != {oracle_names}"
    if len(spark_rows) != len(oracle_rows):
        return f"row counts {len(spark_rows)} != {len(oracle_rows)}"
    pairs = zip(spark_rows, oracle_rows, strict=True)
    wrong = [pair for pair in pairs if repr(pair[0]) != repr(pair[1])]
    if wrong:
        return f"{len(wrong)} rows differ, e.g. {wrong[:shown]}"
    return None


def plan(df):
    """The physical plan as text."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
