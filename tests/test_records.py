"""CSV records of any width, with line breaks in cells, however the files are split."""

import csv
import io
import random
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from twincheck.operators.positions import compare_positions
from twincheck.plans.drop import validate_drop
from twincheck.sources.csvfiles import read_csv
from twincheck.sources.dropfolder import read_staged_csv, stage_archives
from twincheck.sources.records import cells_of, ends_open, file_lines, headers, read_records, stage_records


@pytest.fixture
def split_size(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def change(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


def plain(text):
    """Records by Python's own CSV module."""
    return [row for row in csv.reader(io.StringIO(text, newline="")) if row]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='ab,"\né', max_size=40))
def test_cells_and_states_are_those_of_a_csv_parser(text):
    found, held, is_open = [], [], False
    for line in text.split("\n"):
        if not is_open and not line:
            continue
        held.append(line)
        is_open = ends_open(line, is_open, ",")
        if not is_open:
            found.append(cells_of("\n".join(held), ","))
            held = []
    if held:
        found.append(cells_of("\n".join(held), ","))
    assert found == plain(text)


def records(spark, path):
    rows = stage_records(file_lines(spark, str(path))).collect()
    assert len({(r["file"], r["record"]) for r in rows}) == len(rows)
    return [r["cells"] for r in sorted(rows, key=lambda r: (r["file"], r["record"]))]


def quoted(rng, n, longest):
    rows = [["id", "text", "more"]]
    for i in range(n):
        text = "".join(rng.choice('ab ,"\n\né') for _ in range(rng.choice([0, 3, 30, longest])))
        rows.append([str(i), text, *["z"] * rng.choice([0, 1, 1, 1, 40])])
    return rows


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_records_do_not_depend_on_the_splits(spark, tmp_path, split_size, line_end):
    rows = quoted(random.Random(4), 400, 900)
    with open(tmp_path / "f.csv", "w", newline="", encoding="utf-8-sig") as file:
        csv.writer(file, lineterminator=line_end).writerows(rows)
    for size in (200, 4096, 1 << 20):
        split_size(size)
        if size == 200:
            assert file_lines(spark, str(tmp_path / "f.csv")).rdd.getNumPartitions() > 100
        assert records(spark, tmp_path / "f.csv") == rows


def test_stray_and_unclosed_quotes(spark, tmp_path, split_size):
    text = 'id,v\n1,5" pipe\n2,"6"" pipe"x\n\n3,"a,\nb"\n4, "no"\n"5"\n6,"never closed\n7,x\n'
    (tmp_path / "f.csv").write_text(text)
    expected = plain(text)
    assert expected[-1] == ["6", "never closed\n7,x\n"]
    expected[-1] = ["6", "never closed\n7,x"]
    for size in (5, 11, 1000):
        split_size(size)
        assert records(spark, tmp_path / "f.csv") == expected


def test_a_cell_over_many_splits_and_many_files(spark, tmp_path, split_size):
    long = "\n".join(f'line {i}, "quoted"' for i in range(500))
    for name in "ab":
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            csv.writer(file).writerows([["id", "v"], [f"{name}1", "x"], [f"{name}2", long], [f"{name}3", ""]])
    split_size(256)
    rows = {r["_row_index"]: (r["id"], r["v"]) for r in read_records(spark, str(tmp_path)).collect()}
    assert rows == {i: (f"{n}{k}", {1: "x", 2: long, 3: ""}[k]) for i, (n, k) in enumerate((n, k) for n in "ab" for k in (1, 2, 3))}


def test_names_missing_and_extra_cells(spark, tmp_path):
    (tmp_path / "f.csv").write_text('id,,V,v,_pair\n1\n1,2,3,4,5,"a,b"\n1,2,3,4,5,a,b\n1,2,3,4,5,\n1,2,3,4,5\n')
    read = read_csv(spark, str(tmp_path / "f.csv"), extra_cells=True)
    assert read.columns == ["id", "_c1", "V2", "v3", "_pair4", "_extra_cells", "_row_index"]
    rows = {r["_row_index"]: tuple(r)[:6] for r in read.collect()}
    assert rows[0] == ("1", "", "", "", "", "")
    assert [rows[i][5] for i in range(1, 5)] == ['["a,b"]', '["a","b"]', '[""]', ""]
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "f.csv"), "a string", extra_cells=True)


def test_bytes_that_are_no_utf8_differ(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"v\n\xff\n\xfe\n")
    assert records(spark, tmp_path / "f.csv") == [["v"], ["\\xff"], ["\\xfe"]]
    latin = stage_records(file_lines(spark, str(tmp_path / "f.csv")), encoding="latin-1")
    assert sorted(r["cells"][0] for r in latin.collect()) == ["v", "þ", "ÿ"]


def test_empty_files_have_no_header(spark, tmp_path):
    (tmp_path / "f.csv").write_text("\n\r\n")
    assert headers(stage_records(file_lines(spark, str(tmp_path / "f.csv")))) == {}
    assert read_records(spark, str(tmp_path / "f.csv")).count() == 0


def test_rows_of_any_width_and_line_breaks_in_a_drop_folder(spark, tmp_path):
    """Loose and archived: a row that differs in its thirtieth extra cell, one in a cell of two lines, one by a line end."""
    drop, out, ledger = tmp_path / "drop", str(tmp_path / "out"), str(tmp_path / "ledger")
    drop.mkdir()
    wide = [["id", "v"], ["1", "x", *map(str, range(30))], ["2", "two\nlines"], ["3", "y"]]
    other = [wide[0], [*wide[1][:-1], "changed"], ["2", "two\nlines!"], wide[3]]

    def text(rows):
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator="\n").writerows(rows)
        return out.getvalue()

    for stem, target in (("same", wide), ("differs", other)):
        (drop / f"{stem}_td.csv").write_text(text(wide))
        (drop / f"{stem}_sf.csv").write_text(text(target))
    with zipfile.ZipFile(drop / "z.zip", "w") as archive:
        for stem, target in (("packed", wide), ("packed differs", other)):
            archive.writestr(f"{stem}_td.csv", text(wide))
            archive.writestr(f"{stem}_sf.csv", text(target))
    summary, _ = validate_drop(spark, str(drop), out, ledger)
    found = {r["stem"]: (r["verdict"], r["source_rows"], r["mismatched_rows"], r["error"]) for r in summary.collect()}
    assert found == {
        "same": ("MATCH", 3, 0, ""), "differs": ("MISMATCH", 3, 2, ""),
        "packed": ("MATCH", 3, 0, ""), "packed differs": ("MISMATCH", 3, 2, ""),
    }
    written = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out + "/*/differences")
    assert written.groupBy("diff_pair").count().count() == 2 and written.count() == 4
    staged = stage_archives(spark, str(drop), str(tmp_path / "s")).collect()
    path = next(r["read_path"] for r in staged if r["path"].endswith("packed_td.csv"))
    member = read_staged_csv(spark, path, extra_cells=True)
    assert {r["_row_index"]: r["v"] for r in member.collect()} == {0: "x", 1: "two\nlines", 2: "y"}


def test_jobs_do_not_grow_with_the_pairs(spark, tmp_path):
    def jobs(name, pairs):
        drop = tmp_path / name
        drop.mkdir()
        for i in range(pairs):
            (drop / f"p{i}_td.csv").write_text("id,v\n1,x\n")
            (drop / f"p{i}_sf.csv").write_text(f"id,v\n1,{'x' if i % 2 else 'y'}\n")
        spark.sparkContext.setJobGroup(name, name)
        summary, _ = validate_drop(spark, str(drop), str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-ledger"))
        verdicts = [r["verdict"] for r in summary.collect()]
        assert verdicts.count("MATCH") == pairs // 2 and len(verdicts) == pairs
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    few = jobs("few", 2)
    assert jobs("many", 40) <= few + 6
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_file_without_a_header_does_not_hide_the_others(spark, tmp_path):
    drop, ledger = tmp_path / "drop", str(tmp_path / "ledger")
    drop.mkdir()
    for i in range(5):
        (drop / f"p{i}_td.csv").write_text("\n\n" if i == 3 else "id\n1\n")
        (drop / f"p{i}_sf.csv").write_text("id\n1\n")
    summary, _ = validate_drop(spark, str(drop), str(tmp_path / "out"), ledger)
    found = {r["stem"]: (r["verdict"], r["error"]) for r in summary.collect()}
    assert found.pop("p3") == ("UNKNOWN", "ValueError: a file has no header")
    assert set(found.values()) == {("MATCH", "")} and spark.read.parquet(ledger).count() == 8


def test_positional_comparison_of_records(spark, tmp_path, split_size):
    rows = quoted(random.Random(7), 200, 400)
    changed = [list(r) for r in rows]
    changed[17][1] += "\n"
    changed[150] = [*changed[150], "one more"]
    for name, own in (("a", rows), ("b", [*changed, ["last", "", "z"]])):
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            csv.writer(file).writerows(own)
    found = set()
    for size in (300, 1 << 20):
        split_size(size)
        sides = [read_records(spark, str(tmp_path / f"{name}.csv")) for name in "ab"]
        found.add(tuple(compare_positions(*sides).verdict().first())[:6])
    assert found == {("MISMATCH", 200, 201, 2, 0, 1)}
