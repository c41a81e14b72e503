"""Pairing of dropped files by name. All inputs are DataFrames with a ``path`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.functions.sqltext import literal
from twincheck.sources.dropfolder import SOURCE_SUFFIX, TARGET_SUFFIX

# SQL text over a path.
FOLDER = "regexp_extract({path}, '^(.*)/[^/]*$', 1)"
BASE_NAME = "regexp_extract({path}, '([^/]*)$', 1)"


def folder_name(path: str) -> str:
    return FOLDER.format(path=path)


def base_name(path: str) -> str:
    return BASE_NAME.format(path=path)


def _side(files: DataFrame, suffix: str, path_name: str) -> DataFrame:
    """Files that end in ``suffix``, with their folder and their name up to the suffix."""
    name = base_name("path")
    return files.where(f"endswith(path, {literal(suffix)})").selectExpr(
        f"{folder_name('path')} AS folder",
        f"left({name}, length({name}) - {len(suffix)}) AS stem",
        f"path AS {path_name}",
    )


def grouped_files(
    files: DataFrame, *, source_suffix: str = SOURCE_SUFFIX, target_suffix: str = TARGET_SUFFIX
) -> DataFrame:
    """``folder, stem, source_path, target_path`` of all extracts; a missing one is NULL. One shuffle pairs them all."""
    both = _side(files, source_suffix, "source_path").unionByName(
        _side(files, target_suffix, "target_path"), allowMissingColumns=True
    )
    return both.groupBy("folder", "stem").agg(
        F.expr("max(source_path) AS source_path"), F.expr("max(target_path) AS target_path")
    )


def pair_files(files: DataFrame, **suffixes: str) -> DataFrame:
    """``folder, stem, source_path, target_path``: extracts of one folder whose names agree up to the suffix."""
    return grouped_files(files, **suffixes).where("source_path IS NOT NULL AND target_path IS NOT NULL")


def unpaired_files(files: DataFrame, **suffixes: str) -> DataFrame:
    """``side, path`` of extracts whose counterpart is missing."""
    single = grouped_files(files, **suffixes).where("source_path IS NULL OR target_path IS NULL")
    return single.selectExpr(
        "if(target_path IS NULL, 'source', 'target') AS side", "coalesce(source_path, target_path) AS path"
    )


def unprocessed_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that are not yet in the ledger of processed ones, by the columns both have of path, length and modified."""
    identity = [name for name in ("path", "length", "modified") if name in files.columns and name in ledger.columns]
    return files.join(ledger.select(*identity), identity, "left_anti")
