"""Collects the queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from twincheck.functions.sqltext import alias, quote

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: decimals and times as text, integers as BIGINT."""
    columns = []
    for field in df.schema.fields:
        value = quote(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.TimestampType, T.TimestampNTZType, T.DateType)):
            value = f"cast({value} AS string)"
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            value = f"cast({value} AS bigint)"
        columns.append(alias(value, field.name))
    return df.selectExpr(*columns)
