"""Run the named queries and their SQL side by side."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


SQL_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "FLOAT": "float"}


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """What differs between query and SQL, empty when rows, names, types and values agree."""
    df = query(spark, sf_dir)
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    want_names, want = rows_of(list(described), result.fetchall())
    out = []
    if got_names != want_names:
        out.append(f"columns {got_names} != {want_names}")
    types = dict(df.dtypes)
    for name, sql_type in described.items():
        if types.get(name) != SQL_TYPES.get(sql_type, sql_type):
            out.append(f"type of {name}: {types.get(name)} != {sql_type}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        out.append(f"{len(bad)} rows differ, first: {str(bad[:1])[:600]}")
    return out
