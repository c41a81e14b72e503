"""The list of table pairs to validate: a CSV of 17 text columns, one row per pair."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from twincheck.functions.columns import blank_nulls
from twincheck.sources.csvfiles import read_csv

# The configuration columns, the flag of an active row, the object types.
CONFIG_COLUMNS = [
    "ACTIVE",
    "LOB",
    "TYPE",
    "WF_NAME",
    "SOURCE_SCHEMA_NAME",
    "SOURCE_TABLE_NAME",
    "TARGET_SCHEMA_NAME",
    "TARGET_TABLE_NAME",
    "SOURCE_COLUMNS",
    "TARGET_COLUMNS",
    "UNIQUE_KEYS",
    "SKIP_COLUMNS",
    "DELTA_COLUMNS",
    "SOURCE_FILTER",
    "TARGET_FILTER",
    "AGGREGATE_COLUMNS",
    "AGGREGATE_FUNCTIONS",
]
CONFIG_SCHEMA = ", ".join(f"{name} string" for name in CONFIG_COLUMNS)
ACTIVE_FLAG = "Y"
OBJECT_TYPES = ["TABLE", "VIEW"]

_LISTS = ["UNIQUE_KEYS", "SKIP_COLUMNS", "DELTA_COLUMNS", "AGGREGATE_COLUMNS", "AGGREGATE_FUNCTIONS"]


class ConfigError(ValueError):
    """A pair or a run is described wrongly; raised before any data is read."""


def read_config(spark: SparkSession, path: str, *, delimiter: str = ",") -> DataFrame:
    return read_csv(spark, path, CONFIG_SCHEMA, delimiter=delimiter)


def active_rows(config: DataFrame) -> DataFrame:
    return config.where(F.col("ACTIVE") == ACTIVE_FLAG)


def _items(column: str) -> str:
    items = f"filter(transform(split({column}, ','), i -> trim(i)), i -> i <> '')"
    return f"if(trim({column}) = '', NULL, {items}) AS {column}"


def parse_config(config: DataFrame) -> DataFrame:
    """Trimmed fields, upper-case type, full table names, comma lists as arrays (NULL if blank), and the short code of
    the business unit: the last three characters of its label, lower case."""

    def text(*names: str) -> list[str]:
        return [f"trim({name}) AS {name}" for name in names]

    def full_name(side: str) -> str:
        return f"concat_ws('.', trim({side}_SCHEMA_NAME), trim({side}_TABLE_NAME)) AS {side}_TABLE"

    return blank_nulls(config).selectExpr(
        *text("ACTIVE"),
        "lower(right(trim(LOB), 3)) AS LOB_CODE",
        "upper(trim(TYPE)) AS TYPE",
        *text("WF_NAME"),
        full_name("SOURCE"),
        full_name("TARGET"),
        *text("SOURCE_COLUMNS", "TARGET_COLUMNS"),
        *map(_items, _LISTS),
        *text("SOURCE_FILTER", "TARGET_FILTER"),
    )


@dataclass(frozen=True)
class PairSpec:
    """One pair to validate."""

    source_table: str
    target_table: str
    object_type: str = "TABLE"
    source_columns: str = "*"
    target_columns: str = "*"
    source_filter: str = ""
    target_filter: str = ""
    keys: tuple[str, ...] = ()
    skip: tuple[str, ...] = ()
    aggregate_columns: tuple[str, ...] = ()
    aggregate_functions: tuple[str, ...] = ()

    def __post_init__(self):
        if self.object_type not in OBJECT_TYPES:
            raise ConfigError(f"type {self.object_type!r} is none of {OBJECT_TYPES}")
        if len(self.aggregate_columns) != len(self.aggregate_functions):
            raise ConfigError("every aggregate column needs one aggregate function")


def pair_from_row(row: Row) -> PairSpec:
    """Pair described by a row of :func:`parse_config`."""

    def items(name: str) -> tuple[str, ...]:
        return tuple(row[name] or ())

    return PairSpec(
        source_table=row["SOURCE_TABLE"],
        target_table=row["TARGET_TABLE"],
        object_type=row["TYPE"],
        source_columns=row["SOURCE_COLUMNS"] or "*",
        target_columns=row["TARGET_COLUMNS"] or "*",
        source_filter=row["SOURCE_FILTER"],
        target_filter=row["TARGET_FILTER"],
        keys=items("UNIQUE_KEYS"),
        skip=items("SKIP_COLUMNS"),
        aggregate_columns=items("AGGREGATE_COLUMNS"),
        aggregate_functions=items("AGGREGATE_FUNCTIONS"),
    )
