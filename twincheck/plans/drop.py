"""Validation of file pairs that arrive in a drop folder."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import md5

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from twincheck.functions.sqltext import literal
from twincheck.operators.filepairs import base_name, folder_name, unprocessed_files
from twincheck.operators.positions import PositionalComparison, compare_positions
from twincheck.plans.parallel import run_each
from twincheck.session import scratch_folder
from twincheck.sinks.exports import export_csv, export_pair_differences, run_id
from twincheck.sinks.ledger import read_ledger, record_processed
from twincheck.sources.dropfolder import (
    ARCHIVE_SUFFIX,
    SOURCE_SUFFIX,
    TARGET_SUFFIX,
    archive_errors,
    list_files,
    stage_archives,
    staged_lines,
)
from twincheck.sources.records import PAIR, ROW_INDEX, file_lines, headers, named_cells, stage_records
from twincheck.verdict import MATCH, MISMATCH, UNKNOWN

# Of a path: the folder of a staged member below the staging folder.
_MEMBER = "regexp_extract({}, '(archive_id=[^/]*/member_id=[^/]*)', 1)"

SUMMARY_SCHEMA = (
    "folder string, stem string, verdict string, source_rows bigint, target_rows bigint, mismatched_rows bigint, "
    "surplus_source_rows bigint, surplus_target_rows bigint, source_only_columns string, target_only_columns string, "
    "error string"
)


def dropped_files(spark: SparkSession, folder: str, staging: str) -> tuple[DataFrame, DataFrame | None]:
    """All loose and archived CSV files, and the errors of unreadable archives.

    Columns: ``place`` (where the file lies, or would lie beside its archive), ``read_path``, and its identity: ``path``
    (of a member: archive, exclamation mark, member), ``length`` and ``modified`` (of a member: its archive's). ``file`` is
    what its records bear.
    """
    loose = list_files(spark, folder, ".csv").selectExpr(
        "path AS place", "path AS read_path", "path", "length", "modificationTime AS modified", "file"
    )
    archives = list_files(spark, folder, ARCHIVE_SUFFIX)
    if archives.isEmpty():
        return loose, None
    staged = stage_archives(spark, folder, staging).withColumnRenamed("path", "place")
    archived = staged.join(archives.withColumnRenamed("path", "archive"), "archive").selectExpr(
        "place", "read_path", "concat(archive, '!', member) AS path", "length", "modificationTime AS modified",
        f"{_MEMBER.format('read_path')} AS file",
    )
    return loose.unionByName(archived), archive_errors(spark, staging)


def _sides(files: DataFrame) -> DataFrame:
    """``folder, stem`` of all extracts with, for each side, how many files there are, one of them, and all paths."""
    name = base_name("place")

    def side(suffix: str, is_source: bool) -> DataFrame:
        return files.where(f"endswith(place, {literal(suffix)})").selectExpr(
            f"{folder_name('place')} AS folder",
            f"left({name}, length({name}) - {len(suffix)}) AS stem",
            f"{str(is_source).lower()} AS is_source",
            "struct(path, length, modified, read_path, file) AS file",
        )

    both = side(SOURCE_SUFFIX, True).unionAll(side(TARGET_SUFFIX, False))
    return both.groupBy("folder", "stem").agg(
        *[
            F.expr(f"{what} FILTER (WHERE {where}) AS {label}_{name}")
            for label, where in (("source", "is_source"), ("target", "NOT is_source"))
            for name, what in (("files", "count(1)"), ("file", "max(file)"))
        ],
        F.expr("array_sort(collect_list(file.path)) AS paths"),
    )


@dataclass(frozen=True)
class _Pair:
    folder: str
    stem: str
    source: Row
    target: Row

    @property
    def name(self) -> str:
        return md5(f"{self.folder}/{self.stem}".encode()).hexdigest()

    @property
    def identities(self) -> list[tuple]:
        return [(file["path"], file["length"], file["modified"]) for file in (self.source, self.target)]


def stage_extracts(spark: SparkSession, files: Sequence[Row], archives: str, staging: str) -> DataFrame:
    """Records (``file, record, cells``) of loose and archived extracts, all files in one go."""
    loose = [f["read_path"] for f in files if f["path"] == f["read_path"]]
    packed = [f["read_path"] for f in files if f["path"] != f["read_path"]]
    parts = []
    if loose:
        parts.append(stage_records(file_lines(spark, loose), f"{staging}/loose"))
    if packed:
        members = staged_lines(spark, archives).withColumn("file", F.expr(_MEMBER.format("file")))
        wanted = spark.createDataFrame([(f["file"],) for f in files if f["path"] != f["read_path"]], "file string")
        parts.append(stage_records(members.join(F.broadcast(wanted), "file", "left_semi"), f"{staging}/packed"))
    return reduce(DataFrame.unionByName, parts)


def _compare_group(
    spark: SparkSession, records: DataFrame, pairs: Sequence[_Pair], names: tuple[tuple, tuple], folder: str
) -> list[tuple]:
    """Summary rows of pairs whose files have the same headers, compared in one go; differences go below ``folder``."""
    if not all(names):
        raise ValueError("a file has no header")
    listed = spark.createDataFrame(
        [(file["file"], pair.name, pair.stem, is_source)
         for pair in pairs for file, is_source in ((pair.source, True), (pair.target, False))],
        f"file string, {PAIR} string, stem string, is_source boolean",
    )

    def side(is_source: bool, header: tuple) -> DataFrame:
        of_side = listed.where(f"is_source = {str(is_source).lower()}").select("file", PAIR)
        rows = records.where("record > 0").join(of_side, "file")
        return rows.selectExpr(*named_cells(header), f"record - 1 AS {ROW_INDEX}", PAIR)

    compared = compare_positions(side(True, names[0]), side(False, names[1]))
    found = {row[PAIR]: row.asDict() for row in compared.rows.key_metrics_by(PAIR).toLocalIterator()}
    nothing = dict.fromkeys(
        ("mismatched_keys", "only_source_keys", "only_target_keys", "source_rows", "target_rows"), 0
    )
    differing = [
        (pair.name, pair.stem) for pair in pairs
        if any(found.get(pair.name, nothing)[n] for n in ("mismatched_keys", "only_source_keys", "only_target_keys"))
    ]
    if differing:
        export_pair_differences(
            compared.rows, folder, spark.createDataFrame(differing, "diff_pair string, diff_table string"), key=PAIR
        )
    return [_summary_row(pair.folder, pair.stem, compared, found.get(pair.name, nothing)) for pair in pairs]


def _or_halves(run: Callable[[Sequence[_Pair]], list], pairs: Sequence[_Pair]) -> list:
    """``run`` over the pairs; where it fails, over each half, so that one unreadable pair does not hide the others."""
    try:
        return run(pairs)
    except Exception as error:
        if len(pairs) == 1:
            return [_failed_row(pairs[0].folder, pairs[0].stem, f"{type(error).__name__}: {error}")]
    middle = len(pairs) // 2
    return _or_halves(run, pairs[:middle]) + _or_halves(run, pairs[middle:])


def _summary_row(folder: str, stem: str, compared: PositionalComparison, metrics: dict[str, int]) -> tuple:
    surplus = metrics["only_source_keys"], metrics["only_target_keys"]
    unique = compared.source_only_columns, compared.target_only_columns
    clean = not (metrics["mismatched_keys"] or any(surplus) or any(unique))
    return (
        folder,
        stem,
        MATCH if clean else MISMATCH,
        metrics["source_rows"],
        metrics["target_rows"],
        metrics["mismatched_keys"],
        *surplus,
        *(",".join(names) for names in unique),
        "",
    )


def _failed_row(folder: str, name: str, error: str) -> tuple:
    return (folder, name, UNKNOWN, *[None] * 5, "", "", error)


def validate_drop(
    spark: SparkSession, folder: str, output: str, ledger: str, *, staging: str | None = None, parallel: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Compare every new file pair by row position, export its differences, and enter it in the ledger.

    Returns the summary (one row per pair) and the unpaired files. Only file names, headers and metrics reach the driver;
    rows stay on the executors. All files are read in one go and all pairs of the same headers are compared in one, up to
    ``parallel`` of these at a time, so the number of jobs grows with the headers, not with the pairs. Cells may hold line
    breaks, and rows may be of any width. Differences of files with the same headers share a folder
    ``differences/diff_headers=...``, in which all files have the same columns.

    The ledger is written once, after all pairs. A pair that fails is reported and stays out of the ledger, so the next run
    takes it up again. So does a name that several files bear in one folder, archives included: which of them belong
    together is not known.
    """
    run = run_id()
    archives = staging or scratch_folder(spark, "archives")
    found, broken = dropped_files(spark, folder, archives)
    files = unprocessed_files(found, read_ledger(spark, ledger))
    sides = _sides(files)
    pairs, clashes = [], []
    for row in sides.where("source_files > 0 AND target_files > 0").orderBy("folder", "stem").toLocalIterator():
        if row["source_files"] > 1 or row["target_files"] > 1:
            error = f"ValueError: several files of one name: {', '.join(row['paths'])}"
            clashes.append(_failed_row(row["folder"], row["stem"], error))
        else:
            pairs.append(_Pair(row["folder"], row["stem"], row["source_file"], row["target_file"]))

    def compare(some: Sequence[_Pair]) -> list[tuple]:
        extracts = [file for pair in some for file in (pair.source, pair.target)]
        records = stage_extracts(spark, extracts, archives, scratch_folder(spark, "extracts"))
        names = headers(records)
        groups = defaultdict(list)
        for pair in some:
            groups[tuple(tuple(names.get(f["file"], ())) for f in (pair.source, pair.target))].append(pair)

        def group(item: tuple) -> list[tuple]:
            # Jobs that write to one folder at a time would clear away each other's files.
            headed = f"{output}/{run}/differences/diff_headers=h{md5(repr(item[0]).encode()).hexdigest()}"
            return _or_halves(lambda part: _compare_group(spark, records, part, item[0], headed), item[1])

        return [row for rows in run_each(spark, group, groups.items(), parallel) for row in rows]

    rows = sorted(clashes + (_or_halves(compare, pairs) if pairs else []), key=lambda row: row[:2])
    compared = {row[:2] for row in rows if row[2] != UNKNOWN}
    done = [identity for pair in pairs if (pair.folder, pair.stem) in compared for identity in pair.identities]
    record_processed(spark, ledger, done, run)
    if broken is not None:
        named = broken.selectExpr(f"{folder_name('archive')} AS folder", f"{base_name('archive')} AS name", "error")
        rows += [_failed_row(*archive) for archive in named.toLocalIterator()]
    summary = spark.createDataFrame(rows, SUMMARY_SCHEMA)
    unpaired = sides.where("source_files = 0 OR target_files = 0").selectExpr(
        "if(target_files = 0, 'source', 'target') AS side", "explode(paths) AS path"
    ).selectExpr("side", "path", "regexp_extract(path, '([^/!]*)$', 1) AS name")
    export_csv(summary, f"{output}/{run}/summary", single_file=True)
    export_csv(unpaired, f"{output}/{run}/unpaired", single_file=True)
    return summary, unpaired


FILE_REPORT_SCHEMA = "stem string, item string, status string, reason string"


def file_report(summary: DataFrame, unpaired: DataFrame) -> DataFrame:
    """What :func:`validate_drop` found, as ``stem, item, status, reason``: a row for each pair, file without its
    counterpart, and unreadable archive. ``item`` is the folder and the stem."""
    differing = (
        "concat(mismatched_rows, ' rows differ, ', surplus_source_rows, ' more in the source, ', surplus_target_rows, "
        "' more in the target', if(source_only_columns = '' AND target_only_columns = '', '', ', other columns'))"
    )
    compared = summary.selectExpr(
        "stem",
        "concat(folder, '/', stem) AS item",
        "verdict AS status",
        f"CASE verdict WHEN {literal(MISMATCH)} THEN {differing} WHEN {literal(MATCH)} THEN '' ELSE error END AS reason",
    )
    suffix = f"if(side = 'source', {len(SOURCE_SUFFIX)}, {len(TARGET_SUFFIX)})"
    single = unpaired.selectExpr(
        f"left(name, length(name) - {suffix}) AS stem",
        f"left(path, length(path) - {suffix}) AS item",
        f"{literal(UNKNOWN)} AS status",
        "concat('only the ', side, ' file has arrived') AS reason",
    )
    return compared.unionAll(single)
