"""Files that are dropped into a folder, loose or in zip archives."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twincheck.functions.sqltext import alias, literal
from twincheck.sources.zipsource import ERROR_LINE, LINES_PER_BATCH, SCHEMA, ZipLines, open_file
from twincheck.sources.records import cells_of, header_names, read_records

# Endings of the two extracts of a pair and of archives.
SOURCE_SUFFIX = "_td.csv"
TARGET_SUFFIX = "_sf.csv"
ARCHIVE_SUFFIX = ".zip"


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """``path, length, modificationTime, file`` of the files below ``folder``; no content is read. ``file`` is the path as
    scans of the file tell it."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(folder)
        .select("path", "length", "modificationTime", F.col("_metadata.file_path").alias("file"))
    )


def _can_open(path: str) -> bool:
    try:
        open_file(path).close()
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def archive_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``archive, member, line_number, line`` of every file in the zip archives below ``folder``.

    Each member is unpacked by a task of its own, as a stream. Line ends are removed, a carriage return stays. Bytes that
    are no UTF-8 become escapes such as ``\\xff``, different ones different text. What is unreadable adds a row with line
    number -1, no member, and the error text. Archives on storage that only Spark's readers can open are unpacked whole, one
    by a task.
    """
    paths = [row["path"] for row in list_files(spark, folder, ARCHIVE_SUFFIX).select("path").toLocalIterator()]
    if not paths or _can_open(paths[0]):
        spark.dataSource.register(ZipLines)
        return spark.read.format(ZipLines.name()).option("paths", json.dumps(sorted(paths))).load()
    return _whole_archive_lines(spark, folder)


def _whole_archive_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same from archives as binary columns."""
    lines_per_batch, error_line = LINES_PER_BATCH, ERROR_LINE

    def unpack(batches):
        import io
        import itertools
        import zipfile
        import zlib

        import pandas as pd

        def lines(path, content):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for entry in archive.infolist():
                        if entry.is_dir():
                            continue
                        with archive.open(entry) as stream:
                            for number, line in enumerate(stream):
                                yield path, entry.filename, number, line.rstrip(b"\n").decode("utf-8", "backslashreplace")
            except (zipfile.BadZipFile, zipfile.LargeZipFile, zlib.error, EOFError, OSError, ValueError,
                    NotImplementedError, RuntimeError) as error:
                yield path, "", error_line, f"{type(error).__name__}: {error}"

        for batch in batches:
            rows = itertools.chain.from_iterable(map(lines, batch["path"], batch["content"]))
            while chunk := list(itertools.islice(rows, lines_per_batch)):
                yield pd.DataFrame(chunk, columns=["archive", "member", "line_number", "line"])

    archives = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{ARCHIVE_SUFFIX}")
        .load(folder)
        .select("path", "content")
    )
    return archives.mapInPandas(unpack, SCHEMA)


def stage_archives(spark: SparkSession, folder: str, staging: str) -> DataFrame:
    """Unpack every archive once into a table of lines below ``staging``; the archives stay untouched.

    Returns ``path, read_path, archive, member``: the path a member would have as a loose file beside its archive, the
    folder that holds its lines, and where it is. Members of an archive that could not be read to the end are left out; see ``archive_errors``. A
    folder is written by one task in line order and is read by as many tasks as its size asks for.
    """
    ids = ["archive_id", "member_id"]
    lines = archive_lines(spark, folder).selectExpr("md5(archive) AS archive_id", "md5(member) AS member_id", "*")
    # The explicit sort matches the partition columns, so the writer keeps the order of lines.
    lines.sortWithinPartitions(*ids, "line_number").write.mode("overwrite").partitionBy(*ids).parquet(staging)
    staged = spark.read.parquet(staging)
    broken = archive_errors(spark, staging).select("archive")
    members = staged.where("line_number = 0").join(broken, "archive", "left_anti")
    return members.selectExpr(
        "concat(regexp_extract(archive, '^(.*)/[^/]*$', 1), '/', member) AS path",
        f"concat({literal(staging)}, '/archive_id=', archive_id, '/member_id=', member_id) AS read_path",
        "archive",
        "member",
    )


def archive_errors(spark: SparkSession, staging: str) -> DataFrame:
    """``archive, error`` of staged archives that could not be read to the end, one error for each."""
    staged = spark.read.parquet(staging)
    return staged.where(f"line_number = {ERROR_LINE}").groupBy("archive").agg(F.expr("min(line) AS error"))


def staged_lines(spark: SparkSession, read_path: str) -> DataFrame:
    """``file, block, line`` of staged members, as ``file_lines`` gives them for loose files; ``file`` ends in the member's
    folder below the staging folder."""
    return (
        spark.read.parquet(read_path)
        .where("line_number >= 0")
        .selectExpr(
            "_metadata.file_path AS file", "_metadata.file_block_start AS block", "cast(line AS binary) AS line"
        )
    )


def read_staged_csv(
    spark: SparkSession, read_path: str, *, delimiter: str = ",", extra_cells: bool = False
) -> DataFrame:
    """A staged member as an all-text CSV scan in line order; the first line names the columns. See ``read_csv``."""
    if extra_cells:
        return read_records(spark, read_path, delimiter=delimiter, lines=staged_lines(spark, read_path))
    lines = spark.read.parquet(read_path)
    header = lines.where("line_number = 0").select("line").head()["line"]
    names = header_names(cells_of(header.rstrip("\r"), delimiter))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    filled = lines.where("line_number > 0").selectExpr("rtrim('\r', line) AS text").where("text <> ''")
    parsed = filled.select(F.from_csv("text", schema, {"sep": delimiter, "escape": '"'}).alias("row"))
    return parsed.selectExpr(*[alias(f"coalesce(row.c{i}, '')", name) for i, name in enumerate(names)])
