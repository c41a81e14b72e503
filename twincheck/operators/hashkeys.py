"""A row hash as the key of tables that declare none."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from twincheck.functions.columns import drop_columns, resolve_names
from twincheck.functions.comparability import as_text, cast, key_type, orderable_columns
from twincheck.functions.hashing import HASH_COLUMN, row_hash, safe_row_hash
from twincheck.functions.sqltext import alias, quote
from twincheck.operators.compare import columns_only


def aligned_texts(source: DataFrame, target: DataFrame, names: Sequence[str]) -> tuple[list[str], list[str]]:
    """Text of the named columns on both sides, each pair brought to its common type first."""
    spelled = resolve_names(target, names)
    kinds = [(source.schema[s].dataType, target.schema[t].dataType) for s, t in zip(names, spelled)]

    def texts(columns: Sequence[str], side: int) -> list[str]:
        result = []
        for column, pair in zip(columns, kinds):
            common = key_type(*pair)
            result.append(as_text(cast(quote(column), pair[side], common), common))
        return result

    return texts(names, 0), texts(spelled, 1)


def with_shared_hash_key(
    source: DataFrame,
    target: DataFrame,
    skip: Iterable[str] | None = None,
    *,
    safe: bool = False,
    name: str = HASH_COLUMN,
) -> tuple[DataFrame, DataFrame]:
    """Add the same row hash to both sides: shared columns, in source order, on common types.

    With this key a changed row is never a mismatch; it counts as one row only in the source and one only in the
    target.
    """
    source, target = (orderable_columns(drop_columns(side, skip)) for side in (source, target))
    extra = set(columns_only(source, target)["only_source"])
    names = [column for column in source.columns if column not in extra]
    hashed = safe_row_hash if safe else row_hash
    left, right = aligned_texts(source, target, names)
    return source.selectExpr("*", alias(hashed(left), name)), target.selectExpr("*", alias(hashed(right), name))
