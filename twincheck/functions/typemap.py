"""Native catalog types of the source system in a common vocabulary, and the common vocabulary as Spark types.

Expressions are SQL text.
"""

from __future__ import annotations

from twincheck.functions.sqltext import literal

# Native type codes of the source catalog.
INTEGER_CODES = ["I", "N", "D", "I1", "I8", "I2"]
BYTE_CODES = ["BO", "BF", "BV"]
CHARACTER_CODES = ["CF", "CV", "CO"]
INTERVAL_CODES = ["DY", "DH", "DM", "DS", "HR", "HM", "HS", "MI", "MS", "MO", "SC", "YR", "YM"]
PERIOD_CODE = "PS"
TYPE_OF_CODE = {"TS": "TIMESTAMP_NTZ", "SZ": "TIMESTAMP_TZ", "AT": "TIME", "DA": "DATE", "F": "FLOAT"}
DECIMAL_CODE = "D"
NUMBER_CODE = "N"
WHOLE_NUMBER_PRECISION = 38
INTERVAL_LENGTH = 20
FLOATING_NUMBER_SCALE = 10
UNKNOWN_TYPE = "UNKNOWN"

# Spark type of each common type. Exact numbers take their precision and scale from the catalog row.
EXACT_NUMBER_TYPES = ["NUMBER", "DECIMAL", "BIGINT", "INTEGER"]
TEXT_TYPES = ["TIME", "TEXT", "CHAR", "CLOB", "OBJECT", "ARRAY", "VARIANT"]
SPARK_TYPE = {
    "TIMESTAMP_NTZ": "timestamp_ntz",
    "TIMESTAMP_TZ": "timestamp",
    "TIMESTAMP_LTZ": "timestamp",
    "FLOAT": "double",
    "DOUBLE": "double",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def _in(code: str, codes: list[str]) -> str:
    return f"{code} IN ({', '.join(map(literal, codes))})"


def common_type_name(code: str) -> str:
    single = " ".join(f"WHEN {code} = {literal(native)} THEN {literal(name)}" for native, name in TYPE_OF_CODE.items())
    text_codes = [*BYTE_CODES, *CHARACTER_CODES, *INTERVAL_CODES, PERIOD_CODE]
    return (
        f"CASE WHEN {_in(code, INTEGER_CODES)} THEN 'NUMBER' WHEN {_in(code, text_codes)} THEN 'TEXT' {single} "
        f"ELSE {literal(UNKNOWN_TYPE)} END"
    )


def character_length(code: str, column_length: str, column_format: str) -> str:
    """Declared length; for characters the digits in a display format such as ``X(50)``."""
    digits = f"try_cast(regexp_extract({column_format}, '[(]([0-9]+)[)]', 1) AS bigint)"
    return (
        f"coalesce(CASE WHEN {_in(code, [*BYTE_CODES, PERIOD_CODE])} THEN cast({column_length} AS bigint) "
        f"WHEN {_in(code, CHARACTER_CODES)} THEN {digits} WHEN {_in(code, INTERVAL_CODES)} THEN {INTERVAL_LENGTH}L "
        "END, 0L)"
    )


def numeric_precision(code: str, total_digits: str) -> str:
    """Zero wherever no precision applies, also for zoned timestamps and unknown codes."""
    whole = [native for native in INTEGER_CODES if native != DECIMAL_CODE]
    return (
        f"coalesce(CASE WHEN {_in(code, whole)} THEN {WHOLE_NUMBER_PRECISION}L "
        f"WHEN {code} = {literal(DECIMAL_CODE)} THEN cast({total_digits} AS bigint) END, 0L)"
    )


def numeric_scale(code: str, fractional_digits: str) -> str:
    """Fractional digits; a negative value marks a floating number and counts as a fixed scale."""
    digits = f"cast({fractional_digits} AS bigint)"
    return (
        f"coalesce(CASE WHEN {code} = {literal(DECIMAL_CODE)} THEN {digits} WHEN {code} = {literal(NUMBER_CODE)} "
        f"THEN if({digits} < 0, {FLOATING_NUMBER_SCALE}L, {digits}) END, 0L)"
    )


def spark_type_name(data_type: str, precision: str, scale: str) -> str:
    """Spark DDL type of a common type; NULL where there is none, so that the caller can report it."""
    single = " ".join(f"WHEN {data_type} = {literal(name)} THEN {literal(spark)}" for name, spark in SPARK_TYPE.items())
    return (
        f"CASE WHEN {_in(data_type, EXACT_NUMBER_TYPES)} THEN concat('decimal(', {precision}, ',', {scale}, ')') "
        f"WHEN {_in(data_type, TEXT_TYPES)} THEN 'string' {single} END"
    )


def ddl_item(column_name: str, data_type: str, precision: str, scale: str) -> str:
    """One column of a reader schema, e.g. ```AMOUNT` decimal(18,2)``. NULL for a type without a Spark equivalent."""
    quoted = f"concat('`', replace({column_name}, '`', '``'), '`')"
    return f"concat({quoted}, ' ', {spark_type_name(data_type, precision, scale)})"
