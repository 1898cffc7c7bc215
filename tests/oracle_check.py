"""Run every query on Spark and its SQL on DuckDB, and compare schema and values."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def _rows(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between a Spark result and a SQL result; empty when they agree."""
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    names = list(kinds)
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema.fields:
        want = _KINDS[field.dataType.simpleString()]
        if kinds[field.name] != want:
            problems.append(f"type of {field.name}: {want} != {kinds[field.name]}")
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    want = _rows(con.execute(sql).fetchall(), names)
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    elif got != want:
        differing = [(a, b) for a, b in zip(got, want) if a != b]
        problems.append(f"{len(differing)} of {len(got)} rows differ, first {differing[0]}")
    return problems

