"""Archives by member."""

import os
import random
import subprocess
import sys
import zipfile
from pathlib import Path

import pytest

from twincheck.sources.dropfolder import _whole_archive_lines, archive_errors, archive_lines, stage_archives
from twincheck.sources.zipsource import Member, inflated, members


def texts(rng, n):
    return {f"dir/m{i}.csv": "".join(f"{rng.random()},é{i}\n" for _ in range(rng.choice([0, 1, 300]))) + "last" * (i % 2) for i in range(n)}


def archive(path, found, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as out:
        for name, text in found.items():
            out.writestr(name, text)


def test_one_task_a_member_and_the_same_lines(spark, tmp_path):
    found = texts(random.Random(1), 50)
    archive(tmp_path / "a b%.zip", found)
    archive(tmp_path / "stored.zip", {"x.csv": "1\r\n2\n\n3", "d/": ""}, zipfile.ZIP_STORED)
    lines = archive_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() == 51
    rows = sorted(tuple(r) for r in lines.collect())
    assert rows == sorted(tuple(r) for r in _whole_archive_lines(spark, str(tmp_path)).collect())
    assert [r[3] for r in rows if r[1] == "x.csv"] == ["1\r", "2", "", "3"]


def test_a_member_is_read_in_blocks(tmp_path):
    archive(tmp_path / "z.zip", {"big": "0" * 50_000_000})
    member = members(str(tmp_path / "z.zip"))[0]
    blocks = [len(b) for b in inflated(member)]
    assert sum(blocks) == 50_000_000 and max(blocks) <= 1 << 20 and member.size < 100_000


def test_memory_does_not_grow_with_the_archive(tmp_path):
    """A task's peak memory over a member of 200 MB, beside that of an empty one."""
    archive(tmp_path / "z.zip", {"small": "1\n", "big": "0123456789abcde\n" * 12_500_000})
    script = (
        "import sys, resource; sys.path.insert(0, sys.argv[1]); from twincheck.sources.zipsource import *;"
        "m = [m for m in members(sys.argv[2]) if m.name == sys.argv[3]][0]; n = sum(b.num_rows for b in ZipReader([]).read(m));"
        "print(n, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)"
    )
    peaks = {}
    for name in ("small", "big"):
        args = [sys.executable, "-c", script, str(Path(__file__).resolve().parent.parent), str(tmp_path / "z.zip"), name]
        rows, peaks[name] = map(int, subprocess.run(args, check=True, capture_output=True, text=True).stdout.split())
        assert rows == {"small": 1, "big": 12_500_000}[name]
    assert peaks["big"] - peaks["small"] < 100_000


def test_errors(spark, tmp_path):
    archive(tmp_path / "good.zip", {"a": "1\n"})
    archive(tmp_path / "bad.zip", {"a": "1\n", "b": "7\n" * 1000, "c": "8\n" * 1000}, zipfile.ZIP_STORED)
    content = (tmp_path / "bad.zip").read_bytes()
    (tmp_path / "bad.zip").write_bytes(content.replace(b"7\n7\n", b"7\n8\n", 1).replace(b"8\n8\n8\n8\n", b"8\n7\n8\n8\n", 1))
    (tmp_path / "none.zip").write_bytes(b"")
    (tmp_path / "worse.zip").write_bytes(b"no archive")
    errors = [r for r in archive_lines(spark, str(tmp_path)).collect() if r["line_number"] == -1]
    assert sorted((os.path.basename(r["archive"]), r["member"], r["line"].split(":")[0]) for r in errors) == [
        ("bad.zip", "", "BadZipFile"), ("bad.zip", "", "BadZipFile"), ("worse.zip", "", "BadZipFile")
    ]
    staged = stage_archives(spark, str(tmp_path), str(tmp_path / "s")).collect()
    assert [os.path.basename(r["archive"]) for r in staged] == ["good.zip"]
    assert archive_errors(spark, str(tmp_path / "s")).count() == 2


def test_no_archives_and_truncated_members(spark, tmp_path):
    assert archive_lines(spark, str(tmp_path)).count() == 0
    archive(tmp_path / "z.zip", {"a": "x" * 100}, zipfile.ZIP_STORED)
    member = members(str(tmp_path / "z.zip"))[0]
    for broken in (Member(member.archive, "a", member.offset + 1), Member(member.archive, "a", 0, 10_000, 0, 0)):
        with pytest.raises((zipfile.BadZipFile, EOFError)):
            list(inflated(broken))
