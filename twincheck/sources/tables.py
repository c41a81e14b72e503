"""Tables named by a specification: any Spark format, JDBC or a warehouse connector."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from twincheck.functions.columns import resolve_names
from twincheck.functions.sqltext import pick

_LEADING_WHERE = re.compile(r"^\s*where\b", re.IGNORECASE)
# Fixed value: a column list that stands for all columns.
ALL_COLUMNS = "*"


def split_list(text: str | None) -> list[str]:
    """Items of a comma list without surrounding blanks; an empty text gives an empty list."""
    return [item.strip() for item in (text or "").split(",") if item.strip()]


def filter_condition(text: str | None) -> str:
    """Filter text without its leading WHERE."""
    return _LEADING_WHERE.sub("", text or "").strip()


@dataclass(frozen=True)
class TableSpec:
    """Where a table lives and which part of it is read.

    ``format`` is ``table`` for a table or view of the session catalog, ``jdbc`` or a connector name for a remote
    query, and any file format otherwise. Filter and column list reach the remote system or the scan.
    """

    name: str
    format: str = "table"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    columns: str = ALL_COLUMNS
    filter: str = ""
    schema: str | T.StructType | None = None
    remote: bool = False

    @property
    def query(self) -> str:
        """The read as one SQL statement, for remote systems and for reports."""
        condition = filter_condition(self.filter)
        where = f" WHERE {condition}" if condition else ""
        return f"SELECT {self.columns.strip() or ALL_COLUMNS} FROM {self.name}{where}"


def narrow(df: DataFrame, columns: str = ALL_COLUMNS, condition: str = "") -> DataFrame:
    """Apply a filter text and a column list; the filter may use columns that the list drops."""
    condition = filter_condition(condition)
    if condition:
        df = df.where(condition)
    names = split_list(columns)
    if names and names != [ALL_COLUMNS]:
        df = pick(df, resolve_names(df, names))
    return df


def load_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """Lazy DataFrame of the specified rows and columns."""
    if spec.format == "table":
        return narrow(spark.read.table(spec.name), spec.columns, spec.filter)
    reader = spark.read.format(spec.format).options(**dict(spec.options))
    if spec.remote or spec.format == "jdbc":
        # The remote system runs the projection and the filter. JDBC takes a partial type override instead of a schema.
        reader = reader.option("query", spec.query)
        if spec.schema is not None and spec.format == "jdbc":
            if not isinstance(spec.schema, str):
                raise ValueError("JDBC takes its type override as DDL text")
            return reader.option("customSchema", spec.schema).load()
        return reader.load() if spec.schema is None else reader.schema(spec.schema).load()
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    return narrow(reader.load(spec.path), spec.columns, spec.filter)
