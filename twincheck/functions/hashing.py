"""Row hashes: a text MD5 that serves as a key, and fixed-width digests for cheap equality checks.

Expressions are SQL text.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from twincheck.functions.comparability import as_text
from twincheck.functions.sqltext import alias, literal, quote

# Separator and name of the row-hash key.
HASH_SEPARATOR = "||"
HASH_COLUMN = "HASHED_UNIQUE_KEY"


def row_hash(texts: Sequence[str]) -> str:
    """MD5 over joined text values. NULLs leave no trace, so distinct rows may share a hash."""
    return f"md5(concat_ws({literal(HASH_SEPARATOR)}, {', '.join(texts)}))"


def safe_row_hash(texts: Sequence[str]) -> str:
    """MD5 over length-prefixed text with an explicit NULL token: distinct rows have distinct input."""
    parts = [f"coalesce(concat(length({text}), ':', {text}), '-')" for text in texts]
    return f"md5(concat_ws(',', {', '.join(parts)}))"


def with_hash_key(
    df: DataFrame, skip: Iterable[str] | None = None, *, safe: bool = False, name: str = HASH_COLUMN
) -> DataFrame:
    """Add the row hash of one table. For a pair of tables use the shared hash key, which aligns both sides."""
    unwanted = {item.strip().upper() for item in skip or ()}
    names = [item for item in df.columns if item.upper() not in unwanted]
    texts = [as_text(quote(item), df.schema[item].dataType) for item in names]
    return df.selectExpr("*", alias((safe_row_hash if safe else row_hash)(texts), name))


def _null_masks(columns: Sequence[str]) -> list[str]:
    """Which of the columns are NULL, as one BIGINT of bits per 62 columns."""
    return [
        " | ".join(
            f"if({column} IS NULL, {1 << i}L, 0L)" for i, column in enumerate(columns[start : start + 62])
        )
        for start in range(0, len(columns), 62)
    ]


def null_aware_hash(values: Sequence[str], nulls: Sequence[str], seed: int) -> str:
    """64-bit hash of values and of which of ``nulls`` are NULL (plain ``xxhash64`` skips NULLs)."""
    return f"xxhash64({', '.join([str(seed), *values, *_null_masks(nulls)])})"


def digest_parts(digest: str) -> list[str]:
    """Cut a 64-bit digest into three short integers, whose BIGINT sums cannot overflow below 2^41 rows."""
    mask = (1 << 22) - 1
    return [
        f"({digest} & {mask}L)",
        f"(shiftrightunsigned({digest}, 22) & {mask}L)",
        f"shiftrightunsigned({digest}, 44)",
    ]
