"""Run queries next to their SQL twins in DuckDB and compare names, types, rows and values."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is None, isinstance(v, float) and math.isnan(v), str(v)) for v in row)


def _normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def differences(df, con, sql: str) -> list[str]:
    """What differs; empty if the results are the same."""
    relation = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} and {sorted(relation.columns)}"]
    found = []
    spark_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    sql_types = dict(zip(relation.columns, (str(t) for t in relation.types)))
    for c in names:
        if spark_types[c] != sql_types[c]:
            found.append(f"type of {c}: {spark_types[c]} and {sql_types[c]}")
    order = ", ".join(names)
    ours = [tuple(_normal(v) for v in r) for r in df.select(*names).collect()]
    theirs = [tuple(_normal(v) for v in r) for r in con.sql(f"SELECT {order} FROM ({sql})").fetchall()]
    if len(ours) != len(theirs):
        return [*found, f"rows {len(ours)} and {len(theirs)}"]
    ours.sort(key=_key)
    theirs.sort(key=_key)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        found.append(f"{len(wrong)} of {len(ours)} rows differ, first: {wrong[0]}")
    return found
