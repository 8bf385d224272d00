"""Compare a registered query with its SQL oracle on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def connect(sf_dir: Path) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(sf_dir.glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _kind(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted, every value as text of its kind."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_kind(row[i]) for i in order) for row in rows)


def compare(spark_df, connection, sql: str) -> list[str]:
    """Differences between both results, empty if there are none."""
    relation = connection.sql(sql)
    problems = []
    if sorted(spark_df.columns) != sorted(relation.columns):
        return [f"columns {sorted(spark_df.columns)} vs {sorted(relation.columns)}"]
    spark_types = dict(spark_df.dtypes)
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for column, kind in zip(relation.columns, relation.types, strict=True):
        expected = names.get(spark_types[column], spark_types[column])
        if str(kind) != expected:
            problems.append(f"type of {column}: {expected} vs {kind}")
    ours = canonical(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    theirs = canonical(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows vs {len(theirs)}")
    missing = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
    if missing:
        problems.append(f"{len(missing)} rows differ, first {str(missing[0][0])[:300]} vs {str(missing[0][1])[:300]}")
    return problems
