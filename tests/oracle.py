"""Compare a Spark result with SQL run by DuckDB on the same files."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame

# Spark type name -> DuckDB type name, for the types the queries return.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), repr(v)) for v in row)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    names = sorted(df.columns)
    mine = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    spark_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    theirs_types = {r[0]: r[1] for r in described}
    found = []
    if sorted(theirs_types) != names:
        return [f"columns {names} against {sorted(theirs_types)}"]
    found += [
        f"type of {n}: {spark_types[n]} against {theirs_types[n]}"
        for n in names
        if spark_types[n] != theirs_types[n]
    ]
    columns = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(con.execute(f"SELECT {columns} FROM ({sql})").fetchall(), key=_key)
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows against {len(theirs)}")
    found += [f"{a} against {b}" for a, b in zip(mine, theirs) if a != b][:5]
    return found
