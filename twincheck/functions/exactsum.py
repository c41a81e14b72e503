"""Sums of floating-point columns that do not depend on the order of addition.

Every finite double is an integer times a power of two. Values of one class (16 powers of two wide) share a scale on which
they are integers of at most 71 bits, and these are summed as three BIGINT columns of 24 bits each; nothing is rounded, so
partial sums may be added in any order, on any number of rows below 2^39. The few rows of class sums are added up once,
as whole numbers.

The first part is SQL text and projections, the second a helper on single values.
"""

from __future__ import annotations

from collections.abc import Iterable
from fractions import Fraction

from pyspark.sql import DataFrame

from twincheck.functions.sqltext import quote, struct

#: Powers of two in a class, and the bits of a value after the point of its class's scale. The lowest class begins at the
#: least power of two whose inverse scale is a double.
CLASS_BITS = 16
POINT_BITS = 54
PIECE_BITS = 24
LOWEST_CLASS, HIGHEST_CLASS = -66, 63
#: Classes of what has no finite value; NULL has none and is not summed.
NOT_A_NUMBER, PLUS_INFINITY, MINUS_INFINITY = 1000, 1001, 1002
PIECES = ("p0", "p1", "p2")


def _is_finite(value: str) -> str:
    return f"{value} <> 0 AND NOT isnan({value}) AND abs({value}) < double('Infinity')"


def _own_class(value: str) -> str:
    # log2() may be off by a little at powers of two; a value then lies just outside of its class, which has room for it.
    return f"least(greatest(cast(floor(log2(abs({value})) / {CLASS_BITS}) AS int), {LOWEST_CLASS}), {HIGHEST_CLASS})"


def _kind(value: str, own: str) -> str:
    return (
        f"CASE WHEN isnan({value}) THEN {NOT_A_NUMBER} WHEN {value} = double('Infinity') THEN {PLUS_INFINITY}"
        f" WHEN {value} = double('-Infinity') THEN {MINUS_INFINITY} WHEN {value} = 0 THEN 0"
        f" WHEN {value} IS NOT NULL THEN {own} END"
    )


# Divisions by powers of two and subtractions of the whole part are exact.
def _high(value: str, own: str) -> str:
    return f"abs({value}) / pow(2D, {CLASS_BITS} * {own}) * {float(1 << (POINT_BITS - 2 * PIECE_BITS))!r}D"


def _next(part: str) -> str:
    return f"(({part}) - floor({part})) * {float(1 << PIECE_BITS)!r}D"


def _whole(value: str, part: str) -> str:
    return f"cast(signum({value}) * floor({part}) AS bigint)"


def pieces(value: str) -> str:
    """SQL for a struct (class, p0, p1, p2) of a double; pieces carry its sign, and are NULL for values without them.

    One expression repeats the parts of a value many times: use :func:`with_pieces` on tables.
    """
    own = _own_class(value)
    high = _high(value, own)
    middle = _next(high)
    fields = {"class": _kind(value, own)}
    for name, part in zip(PIECES, (_next(middle), middle, high)):
        fields[name] = f"CASE WHEN {_is_finite(value)} THEN {_whole(value, part)} END"
    return struct(fields)


def with_pieces(df: DataFrame, value: str) -> DataFrame:
    """The columns of :func:`pieces` beside those of a table, whose names may not begin with ``_x``.

    Each part is computed once, in a projection of its own; as one expression they make a method that the JVM leaves
    uncompiled for its size.
    """
    steps = {
        "_x_own": f"CASE WHEN {_is_finite(value)} THEN {_own_class(value)} END",
        "_x_high": _high(value, "_x_own"),
        "_x_middle": _next("_x_high"),
        "_x_low": _next("_x_middle"),
    }
    staged = df
    for name, part in steps.items():
        staged = staged.selectExpr("*", f"{part} AS {name}")
    parts = [f"{_whole(value, part)} AS {name}" for name, part in zip(PIECES, ("_x_low", "_x_middle", "_x_high"))]
    return staged.selectExpr(*map(quote, df.columns), f"{_kind(value, '_x_own')} AS class", *parts)


def exact_total(classes: Iterable[tuple[int, int | None, int | None, int | None]]) -> Fraction | float:
    """The sum of rows (class, sums of p0, p1, p2): exact, or a float if it is none or infinite."""
    total, special = Fraction(0), set()
    for kind, low, middle, high in classes:
        if kind >= NOT_A_NUMBER:
            special.add(kind)
        else:
            whole = ((high or 0) << (2 * PIECE_BITS)) + ((middle or 0) << PIECE_BITS) + (low or 0)
            total += Fraction(whole) * Fraction(2) ** (CLASS_BITS * kind - POINT_BITS)
    if NOT_A_NUMBER in special or len(special) > 1:
        return float("nan")
    if special:
        return float("inf") if PLUS_INFINITY in special else float("-inf")
    return total


def as_double(value: Fraction | float) -> float:
    """The double next to a sum; infinite beyond the largest."""
    try:
        return float(value)
    except OverflowError:
        return float("inf") if value > 0 else float("-inf")
