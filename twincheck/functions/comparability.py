"""When two column types may be compared, and on which common type.

The decision is taken from the schemas on the driver, so no task ever meets an implicit ANSI cast that could throw.
Expressions are SQL text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from twincheck.functions.sqltext import alias, quote

_INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_MAX_DIGITS = 38


@dataclass(frozen=True)
class Tolerance:
    """Numeric slack: ``|s - t| <= absolute + relative * |t|``. Zero means exact."""

    absolute: float = 0.0
    relative: float = 0.0

    @property
    def exact(self) -> bool:
        return self.absolute == 0 and self.relative == 0


EXACT = Tolerance()


def _is_float(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def _exact_digits(kind: T.DataType) -> tuple[int, int] | None:
    """(digits before the point, digits after it) of an exact numeric type."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    digits = _INTEGRAL_DIGITS.get(type(kind))
    return None if digits is None else (digits, 0)


def is_numeric(kind: T.DataType) -> bool:
    return _is_float(kind) or _exact_digits(kind) is not None


def _is_temporal(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def common_type(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """Type both sides can be cast to without losing a value, or None."""
    if left == right:
        return left
    if isinstance(left, T.StringType) and isinstance(right, T.StringType):
        return T.StringType()
    left_digits, right_digits = _exact_digits(left), _exact_digits(right)
    if left_digits and right_digits:
        if not isinstance(left, T.DecimalType) and not isinstance(right, T.DecimalType):
            return T.LongType()
        whole = max(left_digits[0], right_digits[0])
        scale = max(left_digits[1], right_digits[1])
        return T.DecimalType(whole + scale, scale) if whole + scale <= _MAX_DIGITS else None
    if is_numeric(left) and is_numeric(right):
        return T.DoubleType()
    if _is_temporal(left) and _is_temporal(right):
        zoned = isinstance(left, T.TimestampType) or isinstance(right, T.TimestampType)
        return T.TimestampType() if zoned else T.TimestampNTZType()
    return None


def key_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """Common type of a key column. Text against another type is compared as text."""
    common = common_type(left, right)
    if common is None and (isinstance(left, T.StringType) or isinstance(right, T.StringType)):
        common = T.StringType()
    if common is None:
        raise ValueError(f"key columns of types {left.simpleString()} and {right.simpleString()} cannot be compared")
    return common


def cast(value: str, own: T.DataType, wanted: T.DataType, *, lenient: bool = False) -> str:
    if own == wanted:
        return value
    return f"{'try_cast' if lenient else 'cast'}({value} AS {wanted.simpleString()})"


def _holds_unordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_unordered(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds_unordered(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def orderable(value: str, kind: T.DataType) -> str:
    """Form of ``value`` that Spark can order, group and hash.

    Maps become entry lists sorted by key; variants, and maps nested in other values, become JSON text.
    """
    if isinstance(kind, T.MapType) and not _holds_unordered(kind.valueType):
        return f"array_sort(map_entries({value}))"
    return f"to_json({value})" if _holds_unordered(kind) else value


def orderable_columns(df: DataFrame) -> DataFrame:
    """The table with every column in a form that Spark can order, group and hash."""
    fields = df.schema.fields
    if not any(_holds_unordered(field.dataType) for field in fields):
        return df
    return df.selectExpr(*[alias(orderable(quote(f.name), f.dataType), f.name) for f in fields])


def as_text(value: str, kind: T.DataType) -> str:
    if isinstance(kind, T.BinaryType):
        return f"hex({value})"
    nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
    return f"to_json({value})" if nested else f"cast({value} AS string)"


def _canonical_decimal_text(value: str) -> str:
    """Decimal text without trailing zeros, for pairs whose common decimal type would exceed 38 digits."""
    text = f"cast({value} AS string)"
    return f"if(instr({text}, '.') > 0, regexp_replace({text}, '[.]?0+$', ''), {text})"


def _exact_against_float(left: T.DataType, right: T.DataType) -> T.DecimalType | None:
    """For an exact number against a floating one: the decimal type in which they are compared."""
    for exact, other in ((left, right), (right, left)):
        digits = _exact_digits(exact)
        if digits and _is_float(other):
            return T.DecimalType(_MAX_DIGITS, digits[1])
    return None


def _float_as_decimal(value: str, wanted: T.DecimalType) -> str:
    """The decimal that is exactly this floating number as written; NULL if the type has none."""
    number = f"cast({value} AS double)"
    decimal = f"try_cast({number} AS {wanted.simpleString()})"
    return f"if(cast({decimal} AS double) = {number}, {decimal}, NULL)"


def _text_target(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """For text against a typed column: the type the text must parse as."""
    for text, typed in ((left, right), (right, left)):
        if isinstance(text, T.StringType) and (
            is_numeric(typed) or _is_temporal(typed) or isinstance(typed, T.BooleanType)
        ):
            return typed
    return None


def values_match(
    source: str,
    target: str,
    source_type: T.DataType,
    target_type: T.DataType,
    tolerance: Tolerance = EXACT,
) -> str:
    """Never-NULL boolean over values in orderable form.

    NULL equals NULL, NULL never equals a value, text matches a typed value if it parses to it.

    Pairs with no common type match only where both are NULL.
    """
    both_null = f"({source} IS NULL AND {target} IS NULL)"
    common = common_type(source_type, target_type)
    decimal = _exact_against_float(source_type, target_type)
    if decimal is not None:
        left, right = (
            _float_as_decimal(value, decimal) if _is_float(kind) else f"try_cast({value} AS {decimal.simpleString()})"
            for value, kind in ((source, source_type), (target, target_type))
        )
        equal = f"({both_null} OR coalesce({left} = {right}, false))"
    elif common is not None:
        equal = f"({cast(source, source_type, common)} <=> {cast(target, target_type, common)})"
    elif _exact_digits(source_type) and _exact_digits(target_type):
        equal = f"({_canonical_decimal_text(source)} <=> {_canonical_decimal_text(target)})"
    else:
        common = _text_target(source_type, target_type)
        if common is None:
            return both_null
        left = cast(source, source_type, common, lenient=True)
        right = cast(target, target_type, common, lenient=True)
        equal = f"({both_null} OR coalesce({left} = {right}, false))"
    if not tolerance.exact and (common is None or is_numeric(common)):
        left, right = f"try_cast({source} AS double)", f"try_cast({target} AS double)"
        slack = f"{float(tolerance.absolute)!r}D + {float(tolerance.relative)!r}D * abs({right})"
        equal = f"({equal} OR coalesce(abs({left} - {right}) <= {slack}, false))"
    return equal


def canonical_value(value: str, own_type: T.DataType, other_type: T.DataType, *, target: bool = False) -> str:
    """Form of an orderable ``value`` such that values of the two columns get equal hashes if and only if they match.

    Values that can match nothing on the other side carry the mark of their own side.
    """
    marked = f"concat('{'t' if target else 's'}', {as_text(value, own_type)})"
    decimal = _exact_against_float(own_type, other_type)
    if decimal is not None:
        exact = f"try_cast({value} AS {decimal.simpleString()})"
        shared = _float_as_decimal(value, decimal) if _is_float(own_type) else exact
        return f"coalesce(cast({shared} AS string), {marked})"
    common = common_type(own_type, other_type)
    if common is not None:
        return cast(value, own_type, common)
    if _exact_digits(own_type) and _exact_digits(other_type):
        return _canonical_decimal_text(value)
    common = _text_target(own_type, other_type)
    if common is None:
        return marked
    if own_type == common:
        return value
    # Text that does not parse matches nothing.
    return cast(value, own_type, common, lenient=True)
