"""Run a registered query and its DuckDB equivalent and compare them value by value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _sorted(rows, columns):
    table = [tuple(_cell(row[c]) for c in columns) for row in rows]
    return sorted(table, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when row counts, column names, types and every value agree exactly."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns differ: {sorted(set(names) ^ set(spark_df.columns))}"]
    problems = []
    expected_kind = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "boolean": "BOOLEAN",
    }
    for name, kind in spark_df.dtypes:
        if expected_kind.get(kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    columns = sorted(names)
    theirs = _sorted([dict(zip(names, row)) for row in cursor.fetchall()], columns)
    ours = _sorted([row.asDict() for row in spark_df.collect()], columns)
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        problems.append(f"{len(unequal)} of {len(ours)} rows differ, first {columns}: {unequal[0]}")
    return problems
