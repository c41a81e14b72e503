"""Reads of remote databases through Spark's JDBC source or a warehouse connector.

Credentials and URLs come from the caller.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class ReadRange:
    """Split of a remote read into parallel range scans of one numeric, date or timestamp column.

    The bounds only place the cuts; rows outside them are read by the first and the last task.
    """

    column: str
    lower: str
    upper: str
    tasks: int


@dataclass(frozen=True)
class Connection:
    driver: str
    url: str
    user: str | None = None
    password: str | None = None
    extra: Mapping[str, str] | None = None

    def options(self) -> dict[str, str]:
        given = {"driver": self.driver, "url": self.url, "user": self.user, "password": self.password}
        return {name: value for name, value in given.items() if value is not None} | dict(self.extra or {})


def query_options(
    connection: Connection,
    query: str,
    *,
    custom_schema: str | None = None,
    split: ReadRange | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for one SQL query. A split read wraps the query, as Spark allows no split on ``query``."""
    options = connection.options() | {"fetchsize": str(fetch_size)}
    if custom_schema:
        options["customSchema"] = custom_schema
    if split is None:
        return options | {"query": query}
    if split.tasks < 1:
        raise ValueError("a split read needs at least one task")
    return options | {
        "dbtable": f"({query}) split_read",
        "partitionColumn": split.column,
        "lowerBound": split.lower,
        "upperBound": split.upper,
        "numPartitions": str(split.tasks),
    }


def read_query(spark: SparkSession, connection: Connection, query: str, **settings) -> DataFrame:
    """Result of a remote SQL query; ``settings`` are those of :func:`query_options`."""
    return spark.read.format("jdbc").options(**query_options(connection, query, **settings)).load()


def read_connector(
    spark: SparkSession,
    connector: str,
    options: Mapping[str, str],
    query: str,
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """Result of a query sent through a warehouse connector, with an optional imposed schema."""
    reader = spark.read.format(connector).options(**dict(options)).option("query", query)
    return reader.load() if schema is None else reader.schema(schema).load()
