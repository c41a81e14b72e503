"""CSV records of any width, with line breaks in quoted cells, read in parallel from files of any size.

A line break ends a record unless it lies inside a quoted cell, and whether it does depends on all that went before. So
files are read twice. The first pass finds, for every split, in which state it ends and how many records begin in it, both
if it begins between records and if it begins inside a cell; a split is a function of two states. A running composition of
these functions over the splits of a file (one short row each) tells the state in which each really begins, and the number
of its first record. The second pass parses the records; one that spans splits leaves a piece in each, which are put
together by record number. Record numbers do not depend on how the files are split.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twincheck.functions.sqltext import alias
from twincheck.session import scratch_folder

#: Column with the cells of a row beyond its header, so that a ragged row never looks like a whole one.
EXTRA_COLUMN = "_extra_cells"
ROW_INDEX = "_row_index"
#: Which of many pairs of files a row belongs to.
PAIR = "_pair"
RESERVED = (EXTRA_COLUMN, ROW_INDEX, PAIR)
#: Split states are broadcast up to this many splits (about 200 bytes each, so some 20 MB).
MAX_BROADCAST_SPLITS = 100_000
_BATCH_ROWS = 10_000
_MARK = b"\xef\xbb\xbf"
_CHANGED = "the input was cut into other splits than when its records were counted"

SPLIT_SCHEMA = (
    "file string, block bigint, lines bigint, open_if_out boolean, open_if_in boolean, begun_if_out bigint, begun_if_in bigint"
)
PIECE_SCHEMA = "file string, record bigint, block bigint, cells array<string>, piece string"


def quote_end(text: str, at: int) -> int:
    """Where the quoted cell ends that is open at ``at``: the place after its closing quote, or -1. Quotes are doubled."""
    while (at := text.find('"', at)) >= 0:
        if text[at + 1 : at + 2] != '"':
            return at + 1
        at += 2
    return -1


def ends_open(line: str, is_open: bool, delimiter: str) -> bool:
    """Whether a quoted cell is open after ``line``. Only at the beginning of a cell does a quote open one."""
    opening = delimiter + '"'
    at = 0
    if not is_open:
        if not line.startswith('"'):
            at = line.find(opening)
            if at < 0:
                return False
            at += len(delimiter)
        at += 1
    while True:
        at = quote_end(line, at)
        if at < 0:
            return True
        at = line.find(opening, at)
        if at < 0:
            return False
        at += len(opening)


def cells_of(record: str, delimiter: str) -> list[str]:
    """The cells of a record, without a limit to their number; what follows a closing quote belongs to the cell."""
    if '"' not in record:
        return record.split(delimiter)
    cells, at = [], 0
    while True:
        cell = ""
        if record.startswith('"', at):
            end = quote_end(record, at + 1)
            cell = record[at + 1 : end - 1 if end >= 0 else len(record)].replace('""', '"')
            at = end if end >= 0 else len(record)
        end = record.find(delimiter, at)
        if end < 0:
            return [*cells, cell + record[at:]]
        cells.append(cell + record[at:end])
        at = end + len(delimiter)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """((file, block), lines) for stretches of lines of one split, in order. A byte order mark at a file's beginning goes."""
    last = None
    for batch in batches:
        splits = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()))
        at = 0
        for i in range(1, len(splits) + 1):
            if i == len(splits) or splits[i] != splits[at]:
                part = batch.slice(at, i - at)
                if splits[at] != last and splits[at][1] == 0:
                    lines = part.column("line").to_pylist()
                    lines[0] = lines[0].removeprefix(_MARK)
                    part = part.set_column(part.schema.get_field_index("line"), "line", pa.array(lines, pa.binary()))
                last = splits[at]
                yield last, part
                at = i


def _decoded(lines: pa.Array, encoding: str) -> list[str]:
    return [line.decode(encoding, "backslashreplace") for line in lines.to_pylist()]


def _split_states(delimiter: str, encoding: str):
    """Lines (file, block, line) to one row of ``SPLIT_SCHEMA`` for each split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for split, part in _runs(batches):
            state = found.setdefault(split, [0, [False, 0], [True, 0]])
            lines = part.column("line")
            state[0] += len(lines)
            if not pc.any(pc.match_substring(lines, '"')).as_py():
                filled = pc.sum(pc.cast(pc.invert(pc.is_in(lines, pa.array([b"", b"\r"], lines.type))), pa.int64())).as_py()
                for way in state[1:]:
                    way[1] += 0 if way[0] else filled
                continue
            for line in _decoded(lines, encoding):
                for way in state[1:]:
                    way[1] += not way[0] and line not in ("", "\r")
                if '"' in line:
                    out, inside = state[1:]
                    together = out[0] == inside[0]
                    out[0] = ends_open(line, out[0], delimiter)
                    inside[0] = out[0] if together else ends_open(line, inside[0], delimiter)
        rows = [(*split, n, out[0], inside[0], out[1], inside[1]) for split, (n, out, inside) in found.items()]
        names = [field.split()[0] for field in SPLIT_SCHEMA.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def _numbered_splits(states: DataFrame) -> DataFrame:
    """file, block, lines, inside (the split begins in a quoted cell), first (number of the first record that begins in it).

    A split that ends alike from both states sets the state; one that ends in the other state than it begins flips it; the
    rest leave it. So the state before a split is the one last set, flipped as often as splits after that flip it.
    """
    before = "OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    upto = "OVER (PARTITION BY file ORDER BY block)"
    marked = states.selectExpr(
        "*", "if(open_if_out = open_if_in, cast(open_if_out AS int), NULL) AS sets",
        f"sum(if(open_if_out AND NOT open_if_in, 1L, 0L)) {upto} AS flips",
    )
    known = marked.selectExpr(
        "*",
        f"(coalesce(last_value(sets, true) {before}, 0) + coalesce(last_value(flips) {before}, 0L)"
        f" - coalesce(last_value(if(sets IS NULL, NULL, flips), true) {before}, 0L)) % 2 = 1 AS inside",
    )
    return known.selectExpr("*", "if(inside, begun_if_in, begun_if_out) AS begun").selectExpr(
        "file", "block", "lines", "inside", f"coalesce(sum(begun) {before}, 0L) AS first"
    )


def _parsed(delimiter: str, encoding: str):
    """Lines (file, block, line, lines, inside, first) to records, and to pieces of those that span splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        split, seen, expected, record, is_open, held, whole = None, 0, 0, -1, False, [], False

        def table() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(columns, ["file", "record", "block", "cells", "piece"])

        def finish() -> None:
            if split is not None and seen != expected:
                raise ValueError(_CHANGED)
            if held:
                rows.append((split[0], record, split[1], None, "\n".join(held)))

        for of, part in _runs(batches):
            if of != split:
                finish()
                split, seen, held = of, 0, []
                first = part.slice(0, 1).to_pylist()[0]
                if first["lines"] is None:
                    raise ValueError(_CHANGED)
                expected, is_open, record = first["lines"], first["inside"], first["first"] - 1
                # The rest of a record that began in an earlier split is a piece of it.
                whole = not is_open
            seen += part.num_rows
            for line in _decoded(part.column("line"), encoding):
                if not is_open:
                    if line in ("", "\r"):
                        continue
                    record += 1
                is_open = ends_open(line, is_open, delimiter) if '"' in line else is_open
                if held or is_open or not whole:
                    held.append(line)
                    if is_open:
                        continue
                    line = "\n".join(held)
                    held = []
                line = line.removesuffix("\r")
                rows.append((of[0], record, of[1], cells_of(line, delimiter) if whole else None, None if whole else line))
                whole = True
                if len(rows) >= _BATCH_ROWS:
                    yield table()
                    rows.clear()
        finish()
        if rows:
            yield table()

    return run


def _joined(delimiter: str):
    """Rows with a whole record in ``piece`` to rows with its cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [cells_of(text.removesuffix("\r"), delimiter) for text in batch.column("piece").to_pylist()]
            at = batch.schema.get_field_index("cells")
            yield batch.set_column(at, "cells", pa.array(cells, pa.list_(pa.string())))

    return run


def file_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, block, line`` of text files; only line feeds end a line, and lines are bytes."""
    scan = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    return scan.selectExpr(
        "_metadata.file_path AS file", "_metadata.file_block_start AS block", "cast(value AS binary) AS line"
    )


def stage_records(
    lines: DataFrame, staging: str | None = None, *, delimiter: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """The records of ``lines`` (file, block, line: a scan of files without a shuffle) as a table below ``staging``.

    Columns ``file``, ``record`` (from 0 in each file; 0 is the header) and ``cells``. Empty lines are no records. Bytes
    that do not decode become escapes such as ``\\xff``; encodings must hold ASCII as it is. A byte order mark is left out.
    Two passes over the lines and one write, whatever the number of files; no line is shuffled but those of records that
    span splits.
    """
    spark = lines.sparkSession
    folder = staging or scratch_folder(spark, "records")
    splits = _numbered_splits(lines.mapInArrow(_split_states(delimiter, encoding), SPLIT_SCHEMA))
    splits.write.mode("overwrite").parquet(f"{folder}/splits")
    known = spark.read.schema(splits.schema).parquet(f"{folder}/splits")
    if known.count() <= MAX_BROADCAST_SPLITS:
        placed = lines.join(F.broadcast(known), ["file", "block"], "left")
    else:
        tagged = lines.withColumn("_id", F.expr("monotonically_increasing_id()"))
        placed = tagged.join(known, ["file", "block"], "left").sortWithinPartitions("file", "block", "_id").drop("_id")
    pieces = f"{folder}/pieces"
    placed.mapInArrow(_parsed(delimiter, encoding), PIECE_SCHEMA).write.mode("overwrite").parquet(pieces)
    parsed = spark.read.schema(PIECE_SCHEMA).parquet(pieces)
    spanning = parsed.where("piece IS NOT NULL").groupBy("file", "record").agg(
        F.expr("min(block) AS block"),
        F.expr("array_join(transform(array_sort(collect_list(struct(block, piece))), p -> p.piece), '\\n') AS piece"),
    )
    whole = spanning.selectExpr("file", "record", "block", "cast(NULL AS array<string>) AS cells", "piece")
    return parsed.where("cells IS NOT NULL").unionByName(whole.mapInArrow(_joined(delimiter), PIECE_SCHEMA)).select(
        "file", "record", "cells"
    )


def header_names(cells: Sequence[str]) -> list[str]:
    """Column names of a header: empty ones get their place; reserved ones and those that differ in case at most get it
    appended."""
    folded = [name.lower() for name in cells]
    taken = {name for name in folded if folded.count(name) > 1} | set(RESERVED)
    return [f"_c{i}" if not name else f"{name}{i}" if name.lower() in taken else name for i, name in enumerate(cells)]


def named_cells(names: Sequence[str]) -> list[str]:
    """SQL for the columns of a record: its cells by header, empty where it has fewer, and all further ones as JSON."""
    extra = f"if(size(cells) > {len(names)}, to_json(slice(cells, {len(names) + 1}, size(cells))), '')"
    return [
        *[alias(f"coalesce(get(cells, {i}), '')", name) for i, name in enumerate(names)], alias(extra, EXTRA_COLUMN)
    ]


def read_records(
    spark: SparkSession,
    path: str | Sequence[str],
    staging: str | None = None,
    *,
    delimiter: str = ",",
    encoding: str = "UTF-8",
    lines: DataFrame | None = None,
) -> DataFrame:
    """CSV files with a header each as text columns, with ``_extra_cells`` and ``_row_index``.

    The header of the first file names the columns; headers of the others are left out. ``_row_index`` counts the rows
    from 0 over all files in the order of their paths. ``_extra_cells`` holds the cells of a row beyond the header as a JSON
    list, and is empty for other rows. Missing cells are empty. Files are staged by :func:`stage_records` at once, from
    ``lines`` if given.
    """
    records = stage_records(
        file_lines(spark, path) if lines is None else lines, staging, delimiter=delimiter, encoding=encoding
    )
    first = records.where("record = 0").orderBy("file").select("cells").head()
    names = header_names(first["cells"]) if first else []
    files = records.groupBy("file").agg(F.expr("count(1) - 1 AS rows"))
    # One row per file; the file listing itself is already held whole by the driver.
    starts = files.selectExpr("file", "sum(rows) OVER (ORDER BY file) - rows AS before")
    return records.where("record > 0").join(starts, "file").selectExpr(
        *named_cells(names), alias("before + record - 1", ROW_INDEX)
    )


def headers(records: DataFrame) -> dict[str, list[str]]:
    """The header names of all files; one row per file reaches the driver, as the file listing does."""
    rows = records.where("record = 0").select("file", "cells").toLocalIterator()
    return {row["file"]: header_names(row["cells"]) for row in rows}
