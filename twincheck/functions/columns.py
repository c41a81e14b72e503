"""Column-level preparation applied to both sides of a comparison."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twincheck.functions.sqltext import alias, pick, quote, ref


def upper_names(df: DataFrame) -> DataFrame:
    """Upper-case every column name; two names that become equal are an error."""
    names = [name.upper() for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"column names differ only in case: {clashes}")
    return df.toDF(*names)


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip blanks from both ends of every string column, in one projection."""
    return df.selectExpr(
        *[
            alias(f"trim({quote(field.name)})", field.name)
            if isinstance(field.dataType, T.StringType)
            else quote(field.name)
            for field in df.schema.fields
        ]
    )


def drop_columns(df: DataFrame, skip: Iterable[str] | None) -> DataFrame:
    """Drop ``skip`` ignoring case and surrounding blanks; unknown names are ignored."""
    unwanted = {name.strip().upper() for name in skip or ()}
    kept = [name for name in df.columns if name.upper() not in unwanted]
    return df if len(kept) == len(df.columns) else pick(df, kept)


def blank_nulls(df: DataFrame) -> DataFrame:
    """Replace NULL by the empty string in string columns."""
    return df.na.fill("")


def resolve_names(df: DataFrame, names: Sequence[str], *, case_sensitive: bool = False) -> list[str]:
    """Spell ``names`` the way ``df`` does; a missing name is an error."""

    def fold(name: str) -> str:
        return name if case_sensitive else name.upper()

    present = {fold(name): name for name in df.columns}
    missing = [name for name in names if fold(name.strip()) not in present]
    if missing:
        raise ValueError(f"columns {missing} not found in {df.columns}")
    return [present[fold(name.strip())] for name in names]


def impose_schema(df: DataFrame, schema: T.StructType, *, on_error: str = "fail") -> DataFrame:
    """Project ``df`` onto the names, order and types of ``schema``.

    ``on_error="fail"`` raises on a value that does not convert, ``"null"`` turns it into NULL.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    spelled = resolve_names(df, schema.fieldNames())
    function = "cast" if on_error == "fail" else "try_cast"
    return df.selectExpr(
        *[
            alias(f"{function}({quote(name)} AS {field.dataType.simpleString()})", field.name)
            for name, field in zip(spelled, schema.fields)
        ]
    )


def lookup(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Rows where every named column equals its value (NULL matches NULL)."""
    condition = F.lit(True)
    for name, value in zip(resolve_names(df, list(values)), values.values()):
        condition = condition & (ref(name).isNull() if value is None else ref(name) == F.lit(value))
    return df.where(condition)
