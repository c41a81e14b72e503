"""Queries that a remote database runs itself: counts, its column catalog, its index list."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from twincheck.operators.catalog import source_catalog, target_catalog
from twincheck.sources.jdbc import Connection, ReadRange, read_connector, read_query
from twincheck.sources.tables import TableSpec, split_list

# Catalog views of the two systems, and name and type of a row count.
SOURCE_TABLES_VIEW = "dbc.tablesV"
SOURCE_COLUMNS_VIEW = "dbc.columnsV"
SOURCE_INDEXES_VIEW = "dbc.IndicesV"
TARGET_COLUMNS_VIEW = "INFORMATION_SCHEMA.COLUMNS"
COUNT_COLUMN = "ROW_COUNT"
COUNT_SCHEMA = "ROW_COUNT bigint"

# Runs one SQL statement remotely; the second argument is a schema or None.
Run = Callable[[str, "str | None"], DataFrame]


def jdbc_runner(spark: SparkSession, connection: Connection, split: ReadRange | None = None) -> Run:
    """Statements over JDBC. ``split`` reads each result by several tasks and must fit every statement run with it."""
    return lambda query, schema: read_query(spark, connection, query, custom_schema=schema, split=split)


@dataclass(frozen=True)
class SplitBy:
    """Split of a remote table on a numeric, date or timestamp column whose bounds the database tells, by one statement."""

    column: str
    tasks: int


def _bound(value: object, rounded: Callable) -> str:
    # Spark takes whole numbers for cuts, of fractions too; dates and times as text.
    return str(value) if isinstance(value, date) else str(rounded(value))


def find_range(run: Run, table: TableSpec, split: SplitBy) -> ReadRange | None:
    """Range that cuts a table into even pieces of the column's span; None if no row has a value there.

    One row travels. Rows that come or change between this statement and the read are read all the same, as the first and
    the last task take what lies outside the bounds, and the first one the rows without a value.
    """
    asked = f"MIN({split.column}) AS LOWER_BOUND, MAX({split.column}) AS UPPER_BOUND"
    found = run(TableSpec(table.name, columns=asked, filter=table.filter).query, None).first()
    if found is None or found[0] is None:
        return None
    return ReadRange(split.column, _bound(found[0], math.floor), _bound(found[1], math.ceil), split.tasks)


def jdbc_loader(
    spark: SparkSession, connection: Connection, splits: Mapping[str, ReadRange | SplitBy] | None = None
) -> Callable[[str, str, str, str | None], DataFrame]:
    """Loader of a run over many pairs, in which each table has a split of its own; others are read by one task.

    ``splits`` goes by the full table name, in any case. The column must be among those that are read.
    """
    by_table = {name.strip().upper(): split for name, split in (splits or {}).items()}

    def load(table: str, columns: str, condition: str, schema: str | None) -> DataFrame:
        spec = TableSpec(table, columns=columns, filter=condition)
        split = by_table.get(table.strip().upper())
        if split is not None and columns.strip() != "*":
            if split.column.upper() not in [name.upper() for name in split_list(columns)]:
                raise ValueError(f"{table} is split on {split.column}, which is not among the columns read: {columns}")
        if isinstance(split, SplitBy):
            split = find_range(jdbc_runner(spark, connection), spec, split)
        return jdbc_runner(spark, connection, split)(spec.query, schema)

    return load


def connector_runner(spark: SparkSession, connector: str, options: Mapping[str, str]) -> Run:
    """Statements through a warehouse connector, which splits results by itself."""
    return lambda query, schema: read_connector(spark, connector, options, query, schema)


def table_loader(run: Run) -> Callable[[str, str, str, str | None], DataFrame]:
    """Loader of a run over many pairs: projection and filter are part of the remote statement."""
    return lambda table, columns, condition, schema: run(
        TableSpec(table, columns=columns, filter=condition).query, schema
    )


def count_loader(run: Run) -> Callable[[str, str], DataFrame]:
    """Row count of a filtered table, counted by the remote system: one row travels instead of the table."""

    def count(table: str, condition: str) -> DataFrame:
        counted = TableSpec(table, columns=f"CAST(COUNT(*) AS BIGINT) AS {COUNT_COLUMN}", filter=condition)
        return run(counted.query, COUNT_SCHEMA)

    return count


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def catalog_query(view: str, schema_name: str, table_name: str, *, columns: str = "*") -> str:
    """Rows of a source catalog view that describe one table, whatever the case and padding of its name."""
    return (
        f"SELECT {columns} FROM {view} WHERE upper(trim(DatabaseName)) = {_text(schema_name.strip().upper())} "
        f"AND upper(trim(TableName)) = {_text(table_name.strip().upper())}"
    )


def index_query(schema_name: str, table_name: str) -> str:
    return catalog_query(SOURCE_INDEXES_VIEW, schema_name, table_name)


def read_source_catalog(run: Run, schema_name: str, table_name: str) -> DataFrame:
    """Columns of one source table in the common layout; the native types are translated in Spark."""
    tables = run(
        catalog_query(SOURCE_TABLES_VIEW, schema_name, table_name, columns="DatabaseName, TableName, TableKind"), None
    )
    columns = run(
        catalog_query(
            SOURCE_COLUMNS_VIEW,
            schema_name,
            table_name,
            columns="DatabaseName, TableName, ColumnName, ColumnId, ColumnType, ColumnLength, ColumnFormat, "
            "DecimalTotalDigits, DecimalFractionalDigits",
        ),
        None,
    )
    return source_catalog(tables, columns)


def read_target_catalog(run: Run, catalog_name: str, schema_name: str, table_name: str) -> DataFrame:
    """Columns of one target table in the common layout."""
    columns = (
        "table_catalog, table_schema, table_name, column_name, ordinal_position, data_type, "
        "character_maximum_length, numeric_precision, numeric_scale"
    )
    conditions = {"table_catalog": catalog_name, "table_schema": schema_name, "table_name": table_name}
    where = " AND ".join(f"{name} = {_text(value)}" for name, value in conditions.items())
    return target_catalog(run(f"SELECT {columns} FROM {TARGET_COLUMNS_VIEW} WHERE {where}", None))
