"""Row numbers in file order, and comparison of two files row by row.

Numbering does not move the rows: a scan tags each row with its file, its split and an increasing id; rows per split
are counted; running totals over splits give each split its first number; the row number is that number plus the
row's rank in its split. Only the per-split counts (one short row per input split) are ever windowed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.functions.sqltext import alias, literal, quote
from twincheck.operators.compare import NO_DIFFERENCE, RowComparison, columns_only, compare_rows
from twincheck.session import ensure_checkpoint_dir
from twincheck.sources.records import PAIR, ROW_INDEX
from twincheck.verdict import verdict_text

_SPLITS_CHANGED = "the input was cut into other splits than when its rows were counted; number the rows again"
# Per-split counts are broadcast only up to this many splits (about 200 bytes each, so some 20 MB).
MAX_BROADCAST_SPLITS = 100_000


def _tagged(scan: DataFrame) -> DataFrame:
    """The scan with the file and split of each row, and an id that increases within a split."""
    return scan.selectExpr(
        *[quote(column) for column in scan.columns],
        "_metadata.file_path AS _file",
        "_metadata.file_block_start AS _block",
        "monotonically_increasing_id() AS _id",
    )


def split_offsets(tagged: DataFrame) -> DataFrame:
    """First row number, row count and smallest id of every split, in order of file path and position in the file."""
    splits = tagged.groupBy("_file", "_block").agg(F.expr("count(1) AS _rows"), F.expr("min(_id) AS _first_id"))
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    in_file = splits.selectExpr(
        "*", f"coalesce(sum(_rows) OVER (PARTITION BY _file ORDER BY _block {before}), 0L) AS _in_file"
    )
    # One row per file; the file listing itself is already held whole by the driver.
    files = splits.groupBy("_file").agg(F.expr("sum(_rows) AS _file_rows"))
    earlier = files.selectExpr("_file", f"coalesce(sum(_file_rows) OVER (ORDER BY _file {before}), 0L) AS _before_file")
    return in_file.join(earlier, "_file").selectExpr(
        "_file", "_block", "_before_file + _in_file AS _start", "_rows", "_first_id"
    )


def with_row_index(scan: DataFrame, name: str = ROW_INDEX) -> DataFrame:
    """Add a gap-free BIGINT row number, from 0, in file order.

    ``scan`` must read files (CSV, text, Parquet, ...) and may carry filters and added columns, but no shuffle. The
    counting job runs when this is called. Numbers are right only if the scan is later cut into the same splits. Every
    row checks that its rank lies within the counted rows of its split, so a scan that is cut differently, for instance
    because the cluster has grown, fails with an error instead of giving wrong numbers. To rule that out on a cluster
    that grows and shrinks, set ``spark.sql.files.minPartitionNum``.
    """
    ensure_checkpoint_dir(scan.sparkSession)
    tagged = _tagged(scan)
    offsets = split_offsets(tagged.select("_file", "_block", "_id")).checkpoint()
    if offsets.count() <= MAX_BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    error = f"cast(raise_error({literal(_SPLITS_CHANGED)}) AS bigint)"
    number = f"if(_id - _first_id >= 0 AND _id - _first_id < _rows, _start + _id - _first_id, {error})"
    return tagged.join(offsets, ["_file", "_block"], "left").selectExpr(
        alias(number, name), *[quote(column) for column in scan.columns]
    )


class PositionalComparison:
    """Result of comparing two files by row number."""

    def __init__(self, rows: RowComparison, unique_columns: dict[str, list[str]]):
        self.rows = rows
        self.source_only_columns = unique_columns["only_source"]
        self.target_only_columns = unique_columns["only_target"]

    def verdict(self) -> DataFrame:
        """MATCH only if no row differs, neither side has surplus rows, and both have the same columns."""
        same_columns = not (self.source_only_columns or self.target_only_columns)
        return self.rows.metrics().selectExpr(
            f"{verdict_text(f'({NO_DIFFERENCE} AND {str(same_columns).lower()})')} AS verdict",
            "source_rows",
            "target_rows",
            "mismatched_keys AS mismatched_rows",
            "only_source_keys AS surplus_source_rows",
            "only_target_keys AS surplus_target_rows",
            f"{literal(','.join(self.source_only_columns))} AS source_only_columns",
            f"{literal(','.join(self.target_only_columns))} AS target_only_columns",
        )


def compare_positions(
    source: DataFrame, target: DataFrame, *, skip: Iterable[str] | None = None
) -> PositionalComparison:
    """Compare row i with row i. Column names are case-sensitive; surplus rows of the longer side are reported.

    Sides are numbered in file order, unless both have their row numbers, as records do. Rows of many pairs of files are
    compared in one go where both sides tell the pair in ``_pair``.
    """
    numbered = ROW_INDEX in source.columns and ROW_INDEX in target.columns
    sides = (source, target) if numbered else (with_row_index(source), with_row_index(target))
    keys = [PAIR, ROW_INDEX] if all(PAIR in side.columns for side in sides) else [ROW_INDEX]
    compared = compare_rows(*sides, keys, skip=skip, case_sensitive=True)
    return PositionalComparison(compared, columns_only(source, target, case_sensitive=True))
