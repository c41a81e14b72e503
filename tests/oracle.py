"""Runs a registered query and its SQL and compares the two results."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    ordered = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(ordered, key=repr)


_FAMILIES = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "int": "INTEGER",
}


def difference(spark_df, con, sql: str) -> str | None:
    """None if columns, types and rows agree, else what differs."""
    relation = con.sql(sql)
    sql_names, sql_rows = _rows(relation.columns, relation.fetchall())
    names, rows = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if names != sql_names:
        return f"columns {names} but expected {sql_names}"
    types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    for field in spark_df.schema.fields:
        expected = _FAMILIES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if types[field.name] != expected:
            return f"type of {field.name}: {field.dataType.simpleString()} but expected {types[field.name]}"
    if len(rows) != len(sql_rows):
        return f"{len(rows)} rows but expected {len(sql_rows)}"
    for row, expected in zip(rows, sql_rows):
        if row != expected:
            return f"row {row} but expected {expected}"
    return None
