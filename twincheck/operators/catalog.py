"""Column catalogs of both systems in one layout, and their comparison.

Catalog layout: ``SCHEMA_NAME, TABLE_NAME, COLUMN_NAME, COLUMN_POSITION, DATA_TYPE, CHARACTER_MAX_LENGTH,
NUMERIC_PRECISION, NUMERIC_SCALE``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twincheck.functions import typemap
from twincheck.functions.sqltext import literal
from twincheck.operators.compare import RowComparison, compare_rows

# Names of the catalog layout, its key, and the object kinds that hold columns.
CATALOG_COLUMNS = [
    "SCHEMA_NAME",
    "TABLE_NAME",
    "COLUMN_NAME",
    "COLUMN_POSITION",
    "DATA_TYPE",
    "CHARACTER_MAX_LENGTH",
    "NUMERIC_PRECISION",
    "NUMERIC_SCALE",
]
CATALOG_KEY = ["SCHEMA_NAME", "TABLE_NAME", "COLUMN_NAME"]
TABLE_KINDS = ["O", "T", "V"]


def _clean(identifier: str) -> str:
    return f"upper(trim({identifier}))"


def same_identifier(column: str, name: str | None) -> str:
    """Equality that ignores case and padding; no name means no restriction."""
    return "true" if name is None else f"{_clean(column)} = {literal(name.strip().upper())}"


def _one_of(column: str, names: Sequence[str] | None) -> str:
    if names is None or list(names) == ["*"]:
        return "true"
    return f"{_clean(column)} IN ({', '.join(literal(name.strip().upper()) for name in names)})"


def columns_of(columns: DataFrame, schema_name: str | None = None, table_name: str | None = None) -> DataFrame:
    """Raw catalog rows of one table, or of all."""
    return columns.where(
        f"{same_identifier('DatabaseName', schema_name)} AND {same_identifier('TableName', table_name)}"
    )


def source_catalog(
    tables: DataFrame,
    columns: DataFrame,
    *,
    schema_name: str | None = None,
    table_name: str | None = None,
    column_names: Sequence[str] | None = None,
) -> DataFrame:
    """Source catalog in the common layout: tables and views joined to their columns, native types translated.

    Positions number the columns of a table from 1 and are taken before ``column_names`` restricts the list, as on
    the target side.
    """
    kinds = ", ".join(map(literal, TABLE_KINDS))
    held = columns_of(tables, schema_name, table_name).where(f"TableKind IN ({kinds})")
    joined = held.select("DatabaseName", "TableName").join(
        columns_of(columns, schema_name, table_name), ["DatabaseName", "TableName"]
    )
    code = "trim(ColumnType)"
    position = "row_number() OVER (PARTITION BY DatabaseName, TableName ORDER BY ColumnId)"
    return joined.selectExpr(
        f"{_clean('DatabaseName')} AS SCHEMA_NAME",
        f"{_clean('TableName')} AS TABLE_NAME",
        f"{_clean('ColumnName')} AS COLUMN_NAME",
        f"cast({position} AS bigint) AS COLUMN_POSITION",
        f"{typemap.common_type_name(code)} AS DATA_TYPE",
        f"{typemap.character_length(code, 'ColumnLength', 'ColumnFormat')} AS CHARACTER_MAX_LENGTH",
        f"{typemap.numeric_precision(code, 'DecimalTotalDigits')} AS NUMERIC_PRECISION",
        f"{typemap.numeric_scale(code, 'DecimalFractionalDigits')} AS NUMERIC_SCALE",
    ).where(_one_of("COLUMN_NAME", column_names))


def target_catalog(
    columns: DataFrame,
    *,
    catalog_name: str | None = None,
    schema_name: str | None = None,
    table_name: str | None = None,
    column_names: Sequence[str] | None = None,
) -> DataFrame:
    """Target information-schema columns in the common layout; missing lengths and digits count as 0."""

    conditions = [
        same_identifier("table_catalog", catalog_name),
        same_identifier("table_schema", schema_name),
        same_identifier("table_name", table_name),
        _one_of("column_name", column_names),
    ]
    return columns.where(" AND ".join(conditions)).selectExpr(
        "table_schema AS SCHEMA_NAME",
        "table_name AS TABLE_NAME",
        "column_name AS COLUMN_NAME",
        "cast(ordinal_position AS bigint) AS COLUMN_POSITION",
        "data_type AS DATA_TYPE",
        "coalesce(cast(character_maximum_length AS bigint), 0L) AS CHARACTER_MAX_LENGTH",
        "coalesce(cast(numeric_precision AS bigint), 0L) AS NUMERIC_PRECISION",
        "coalesce(cast(numeric_scale AS bigint), 0L) AS NUMERIC_SCALE",
    )


def in_position_order(catalog: DataFrame) -> DataFrame:
    return catalog.orderBy("SCHEMA_NAME", "TABLE_NAME", "COLUMN_POSITION")


# Fixed value: where Spark keeps the declared type of a CHAR or VARCHAR column.
_DECLARED = "__CHAR_VARCHAR_TYPE_STRING"


def declared_length(field: T.StructField) -> int:
    """Characters of a CHAR or VARCHAR column, 0 for text of any length and other types."""
    if isinstance(field.dataType, (T.CharType, T.VarcharType)):
        return field.dataType.length
    declared = re.fullmatch(r"(?:var)?char\((\d+)\)", str(field.metadata.get(_DECLARED, "")).strip().lower())
    return int(declared.group(1)) if declared else 0


def _described(kind: T.DataType) -> tuple[str, int, int]:
    if isinstance(kind, T.DecimalType):
        return "NUMBER", kind.precision, kind.scale
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "NUMBER", typemap.WHOLE_NUMBER_PRECISION, 0
    names = {
        T.FloatType: "FLOAT",
        T.DoubleType: "FLOAT",
        T.BooleanType: "BOOLEAN",
        T.DateType: "DATE",
        T.TimestampType: "TIMESTAMP_LTZ",
        T.TimestampNTZType: "TIMESTAMP_NTZ",
        T.ArrayType: "ARRAY",
        T.MapType: "OBJECT",
        T.StructType: "OBJECT",
        T.VariantType: "VARIANT",
    }
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "TEXT", 0, 0
    return names.get(type(kind), typemap.UNKNOWN_TYPE), 0, 0


def catalog_of(spark: SparkSession, df: DataFrame, schema_name: str, table_name: str) -> DataFrame:
    """Catalog of a table that Spark itself holds, taken from its schema, with the declared lengths of CHAR and VARCHAR."""
    rows = []
    for position, item in enumerate(df.schema.fields, start=1):
        name, precision, scale = _described(item.dataType)
        rows.append((schema_name.upper(), table_name.upper(), item.name.upper(), position, name, declared_length(item), precision, scale))
    layout = ", ".join(
        f"{name} {'string' if name in (*CATALOG_KEY, 'DATA_TYPE') else 'bigint'}" for name in CATALOG_COLUMNS
    )
    return spark.createDataFrame(rows, layout)


def compare_catalogs(source: DataFrame, target: DataFrame, *, one_table: bool = False) -> RowComparison:
    """Compare position, type, length, precision and scale of every column.

    With ``one_table`` both catalogs describe one table, which may bear another name in the target.
    """
    if one_table:
        return compare_rows(source, target, ["COLUMN_NAME"], skip=["SCHEMA_NAME", "TABLE_NAME"])
    return compare_rows(source, target, CATALOG_KEY)


def reader_schemas(catalog: DataFrame) -> DataFrame:
    """DDL reader schema per table, and the columns whose type has no Spark equivalent.

    A group holds the columns of one table.
    """
    item = typemap.ddl_item("COLUMN_NAME", "DATA_TYPE", "NUMERIC_PRECISION", "NUMERIC_SCALE")
    placed = f"array_sort(collect_list(struct(COLUMN_POSITION, COLUMN_NAME, {item} AS ddl))) AS items"
    mapped, unmapped = "filter(items, i -> i.ddl IS NOT NULL)", "filter(items, i -> i.ddl IS NULL)"
    return (
        catalog.groupBy("SCHEMA_NAME", "TABLE_NAME")
        .agg(F.expr(placed))
        .selectExpr(
            "SCHEMA_NAME",
            "TABLE_NAME",
            f"concat_ws(', ', {mapped}.ddl) AS ddl",
            f"concat_ws(',', {unmapped}.COLUMN_NAME) AS unmapped_columns",
        )
    )
