"""SQL expression text.

Operators build one expression per column. As text, such an expression costs one call to the JVM; as a tree of
``Column`` objects it would cost one per node, which adds up to seconds on wide tables.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """A column name that is safe whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r")
    return f"'{escaped}'"


def ref(name: str) -> Column:
    return F.col(quote(name))


def alias(expression: str, name: str) -> str:
    return f"{expression} AS {quote(name)}"


def struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"{literal(name)}, {value}" for name, value in fields.items()) + ")"


def array(items: Iterable[str]) -> str:
    return f"array({', '.join(items)})"


def pick(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Project onto columns by exact name."""
    return df.selectExpr(*[quote(name) for name in names])
