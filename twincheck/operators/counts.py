"""Whole-table checks: row counts, duplicate keys, frequency tables, row multisets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.functions.columns import resolve_names
from twincheck.functions.comparability import as_text, cast, key_type, orderable_columns
from twincheck.functions.hashing import row_hash, safe_row_hash
from twincheck.functions.sqltext import alias, array, literal, quote, struct
from twincheck.operators.hashkeys import aligned_texts
from twincheck.verdict import verdict_text

_SIDE_COUNTS = ["count_if(_is_source) AS source_rows", "count_if(NOT _is_source) AS target_rows"]
COUNT_STATUS = (
    "CASE WHEN target_rows = 0 THEN 'only_source' WHEN source_rows = 0 THEN 'only_target' "
    "WHEN source_rows = target_rows THEN 'match' ELSE 'mismatch' END AS status"
)


def compare_row_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both counts, their signed difference and the verdict. No data column is read."""
    both = source.selectExpr("true AS _is_source").unionAll(target.selectExpr("false AS _is_source"))
    return _count_report(both.selectExpr(*_SIDE_COUNTS))


def compare_given_counts(source_count: DataFrame, target_count: DataFrame) -> DataFrame:
    """The same report from two one-row frames that hold a count, for tables that are counted where they live."""
    both = source_count.toDF("n").selectExpr("n AS source", "cast(NULL AS bigint) AS target").unionAll(
        target_count.toDF("n").selectExpr("cast(NULL AS bigint)", "n")
    )
    return _count_report(
        both.selectExpr("cast(max(source) AS bigint) AS source_rows", "cast(max(target) AS bigint) AS target_rows")
    )


def _count_report(counts: DataFrame) -> DataFrame:
    return counts.selectExpr(
        "*",
        "source_rows - target_rows AS difference",
        f"{verdict_text('source_rows = target_rows')} AS verdict",
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    grouped = df.groupBy(*[quote(name) for name in resolve_names(df, keys)]).agg(F.expr("count(1) AS row_count"))
    return grouped.where("row_count > 1")


def frequency_texts(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """SQL for the columns of both sides as text, on the type both are compared on."""
    source_names, target_names = resolve_names(source, columns), resolve_names(target, columns)
    kinds = [(source.schema[s].dataType, target.schema[t].dataType) for s, t in zip(source_names, target_names)]
    commons = [key_type(*pair) for pair in kinds]
    return tuple(
        [as_text(cast(quote(name), pair[side], common), common) for name, pair, common in zip(names, kinds, commons)]
        for side, names in enumerate((source_names, target_names))
    )


def compare_frequencies(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per distinct value of each column on both sides (NULL is a value): ``column_name, value, source_rows,
    target_rows, status``.

    All columns are counted in one scan per side: each row is spread into (column, value) pairs, which the map-side
    combine collapses again before the exchange.
    """
    source, target = orderable_columns(source), orderable_columns(target)
    source_texts, target_texts = frequency_texts(source, target, columns)

    def spread(df: DataFrame, texts: Sequence[str], is_source: str) -> DataFrame:
        pairs = [struct({"column_name": literal(label), "value": value}) for label, value in zip(columns, texts)]
        return df.selectExpr(f"explode({array(pairs)}) AS pair").selectExpr("pair.*", f"{is_source} AS _is_source")

    both = spread(source, source_texts, "true").unionAll(spread(target, target_texts, "false"))
    counted = both.groupBy("column_name", "value").agg(*map(F.expr, _SIDE_COUNTS))
    return counted.selectExpr("*", COUNT_STATUS)


def multiset_differences(
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    safe: bool = True,
) -> DataFrame:
    """Row hashes that occur a different number of times on the two sides, with both counts.

    Needs no key. A changed row shows up as one surplus row on each side. Only the hash travels, and equal rows are
    combined before the exchange.
    """
    source, target = orderable_columns(source), orderable_columns(target)
    names = resolve_names(source, columns if columns is not None else source.columns)
    left, right = aligned_texts(source, target, names)
    hashed = safe_row_hash if safe else row_hash
    both = source.selectExpr(alias(hashed(left), "row_hash"), "true AS _is_source").unionAll(
        target.selectExpr(alias(hashed(right), "row_hash"), "false AS _is_source")
    )
    return both.groupBy("row_hash").agg(*map(F.expr, _SIDE_COUNTS)).where("source_rows <> target_rows")
