"""Zip archives as a data source: a partition for each member, planned from the central directories.

A task seeks to its member and inflates it as a stream, so neither archive nor member is ever held whole, and an archive of
many members is read by many tasks. Archives are opened by path, on the driver for their directories and in the tasks for
the bytes of one member.
"""

from __future__ import annotations

import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "archive string, member string, line_number bigint, line string"
ERROR_LINE = -1
LINES_PER_BATCH = 20_000
_BLOCK = 1 << 20
# Fixed values of the format: a local header's length and beginning, where it tells the lengths of what follows, and methods.
_LOCAL_HEADER, _LOCAL_MARK, _LENGTHS = 30, b"PK\x03\x04", slice(26, 30)
_ENCRYPTED = 1
_BROKEN = (
    zipfile.BadZipFile, zipfile.LargeZipFile, zlib.error, EOFError, OSError, ValueError, NotImplementedError, RuntimeError,
)


def open_file(path: str):
    """A file that can be sought in, by the path that Spark's readers tell."""
    if "://" not in path:
        return open(path.removeprefix("file:"), "rb")
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


@dataclass
class Member(InputPartition):
    """Where a member lies in its archive; ``error`` in place of a member that cannot be read."""

    archive: str
    name: str = ""
    offset: int = 0
    size: int = 0
    method: int = 0
    crc: int = 0
    error: str = ""


def _as_error(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def members(path: str) -> list[Member]:
    """The members of an archive, by its central directory alone."""
    try:
        with open_file(path) as file, zipfile.ZipFile(file) as archive:
            found = []
            for entry in archive.infolist():
                if entry.is_dir():
                    continue
                error = ""
                if entry.flag_bits & _ENCRYPTED:
                    error = f"RuntimeError: File {entry.filename!r} is encrypted, password required for extraction"
                elif entry.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                    error = f"NotImplementedError: compression type {entry.compress_type} of {entry.filename!r}"
                found.append(
                    Member(path, entry.filename, entry.header_offset, entry.compress_size, entry.compress_type, entry.CRC, error)
                )
            return found
    except pa.ArrowInvalid as error:
        # Remote files refuse to seek before their beginning by another error than local ones.
        return [Member(path, error=_as_error(zipfile.BadZipFile(f"File is not a zip file ({error})")))]
    except _BROKEN as error:
        return [Member(path, error=_as_error(error))]


def inflated(member: Member) -> Iterator[bytes]:
    """The bytes of a member in blocks; raises at the end if they are not what the directory says."""
    with open_file(member.archive) as file:
        file.seek(member.offset)
        header = file.read(_LOCAL_HEADER)
        if len(header) < _LOCAL_HEADER or header[:4] != _LOCAL_MARK:
            raise zipfile.BadZipFile(f"Bad magic number for file header of {member.name!r}")
        file.seek(member.offset + _LOCAL_HEADER + sum(struct.unpack("<HH", header[_LENGTHS])))
        left, crc = member.size, 0
        inflate = zlib.decompressobj(-zlib.MAX_WBITS) if member.method == zipfile.ZIP_DEFLATED else None
        while left:
            raw = file.read(min(left, _BLOCK))
            if not raw:
                raise EOFError(f"{member.name!r} ends early")
            left -= len(raw)
            # A block may inflate a thousandfold, so it is taken in steps.
            block = inflate.decompress(raw, _BLOCK) if inflate else raw
            while block:
                crc = zlib.crc32(block, crc)
                yield block
                block = inflate.decompress(inflate.unconsumed_tail, _BLOCK) if inflate else b""
        if crc != member.crc:
            raise zipfile.BadZipFile(f"Bad CRC-32 for file {member.name!r}")


def member_lines(member: Member) -> Iterator[list[bytes]]:
    """The lines of a member in lists of some thousand, without line feeds."""
    rest: list[bytes] = []
    lines: list[bytes] = []
    for block in inflated(member):
        first, *more = block.split(b"\n")
        rest.append(first)
        if more:
            lines.append(b"".join(rest))
            lines += more[:-1]
            rest = [more[-1]]
        if len(lines) >= LINES_PER_BATCH:
            yield lines
            lines = []
    if any(rest):
        lines.append(b"".join(rest))
    if lines:
        yield lines


def _batch(member: Member, first: int, lines: list[str]) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([member.archive] * n, pa.string()),
            pa.array([member.name if first != ERROR_LINE else ""] * n, pa.string()),
            pa.array(range(first, first + n), pa.int64()),
            pa.array(lines, pa.string()),
        ],
        names=["archive", "member", "line_number", "line"],
    )


class ZipReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[Member]:
        return [member for path in self.paths for member in members(path)] or [Member("")]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if partition.error:
            yield _batch(partition, ERROR_LINE, [partition.error])
        elif partition.archive:
            number = 0
            try:
                for lines in member_lines(partition):
                    yield _batch(partition, number, [line.decode("utf-8", "backslashreplace") for line in lines])
                    number += len(lines)
            except _BROKEN as error:
                yield _batch(partition, ERROR_LINE, [_as_error(error)])


class ZipLines(DataSource):
    """``spark.read.format("ziplines").option("paths", <JSON list of archives>)``."""

    @classmethod
    def name(cls) -> str:
        return "ziplines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZipReader:
        return ZipReader(json.loads(self.options["paths"]))
