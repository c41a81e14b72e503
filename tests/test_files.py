"""Row numbers, file pairs and the drop folder."""

import os
import pathlib
import subprocess
import sys
import zipfile

import pytest

from twincheck.operators.filepairs import pair_files, unpaired_files
from twincheck.operators.positions import compare_positions, with_row_index
from twincheck.plans.drop import validate_drop
from twincheck.session import clear_scratch, ensure_checkpoint_dir, scratch_folder
from twincheck.sinks.exports import export_csv, read_export
from twincheck.sources.csvfiles import read_csv
from twincheck.sources.dropfolder import archive_lines, list_files, read_staged_csv, stage_archives
from twincheck.streaming.arrivals import record_arrivals


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def write(path, rows, header="id,v"):
    path.write_text(header + "\n" + "".join(f"{row}\n" for row in rows))


def test_row_numbers_follow_the_file_over_many_splits(spark, tmp_path, small_splits):
    write(tmp_path / "f.csv", [f"{i},v{i}" for i in range(5000)])
    df = read_csv(spark, str(tmp_path / "f.csv"))
    assert df.rdd.getNumPartitions() > 4
    assert with_row_index(df).where("_row_index <> cast(id AS bigint)").isEmpty()
    kept = with_row_index(df.where("id % 3 <> 1"))
    assert kept.where("_row_index <> cast(id AS bigint) - (cast(id AS bigint) + 1) DIV 3").isEmpty()
    assert kept.select("_row_index").distinct().count() == kept.count()


def test_row_numbers_run_on_over_the_files_of_a_folder(spark, tmp_path, small_splits):
    for part in range(4):
        write(tmp_path / f"part-{part}.csv", [f"{part * 1000 + i},x" for i in range(1000)])
    indexed = with_row_index(read_csv(spark, str(tmp_path)))
    assert indexed.where("_row_index <> cast(id AS bigint)").isEmpty()
    assert indexed.count() == 4000


def test_changed_splits_are_an_error_not_a_wrong_number(spark, tmp_path, small_splits):
    write(tmp_path / "f.csv", [f"{i},v{i}" for i in range(5000)])
    indexed = with_row_index(read_csv(spark, str(tmp_path / "f.csv")))
    for size in ("3000", "9000", "100000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        with pytest.raises(Exception, match="number the rows again"):
            indexed.select("_row_index").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    assert indexed.count() == 5000


def test_positional_comparison(spark, tmp_path):
    write(tmp_path / "a.csv", ["1,x", "2,y", "3,"], "id,V")
    write(tmp_path / "b.csv", ["1,x", "2,z"], "id,V")
    a, b = read_csv(spark, str(tmp_path / "a.csv")), read_csv(spark, str(tmp_path / "b.csv"))
    assert tuple(compare_positions(a, b).verdict().first())[:6] == ("MISMATCH", 3, 2, 1, 1, 0)
    assert compare_positions(a, a).verdict().first()["verdict"] == "MATCH"


def test_positional_column_names_are_case_sensitive(spark, tmp_path):
    write(tmp_path / "a.csv", ["1,x"], "id,V")
    write(tmp_path / "b.csv", ["1,x"], "id,v")
    result = compare_positions(
        read_csv(spark, str(tmp_path / "a.csv")), read_csv(spark, str(tmp_path / "b.csv"))
    ).verdict().first()
    assert (result["verdict"], result["source_only_columns"], result["target_only_columns"]) == ("MISMATCH", "V", "v")


def test_pairing_needs_the_exact_stem(spark):
    paths = ["/d/a_b_td.csv", "/d/a_b_c_sf.csv", "/d/a_b_sf.csv", "/e/a_b_c_td.csv", "/d/notes.csv"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    assert [tuple(r) for r in pair_files(files).collect()] == [("/d", "a_b", "/d/a_b_td.csv", "/d/a_b_sf.csv")]
    assert sorted(tuple(r) for r in unpaired_files(files).collect()) == [
        ("source", "/e/a_b_c_td.csv"),
        ("target", "/d/a_b_c_sf.csv"),
    ]
    other = pair_files(files, source_suffix="_c_sf.csv", target_suffix="_sf.csv")
    assert [r["stem"] for r in other.collect()] == ["a_b"]


def make_archive(folder, name, members):
    with zipfile.ZipFile(folder / name, "w", zipfile.ZIP_DEFLATED) as archive:
        for member, text in members.items():
            archive.writestr(member, text)


def test_archives_are_read_line_by_line(spark, tmp_path):
    text = 'id,"a, b",,x\r\n1,"q, r",,ä\r\n\r\n2,,3,\r\n'
    make_archive(tmp_path, "z.zip", {"m_td.csv": text, "sub/": "", "sub/n_sf.csv": "id\n1"})
    lines = archive_lines(spark, str(tmp_path)).where("member = 'm_td.csv'").orderBy("line_number").collect()
    assert [r["line_number"] for r in lines] == [0, 1, 2, 3]
    members = stage_archives(spark, str(tmp_path), str(tmp_path / "s"))
    staged = {r["path"].rsplit("/", 1)[1]: r["read_path"] for r in members.collect()}
    assert set(staged) == {"m_td.csv", "n_sf.csv"}
    member = read_staged_csv(spark, staged["m_td.csv"])
    assert member.columns == ["id", "a, b", "_c2", "x"]
    assert [tuple(r) for r in with_row_index(member).collect()] == [(0, "1", "q, r", "", "ä"), (1, "2", "", "3", "")]


def test_drop_folder(spark, tmp_path):
    drop, out, ledger = tmp_path / "drop", str(tmp_path / "out"), str(tmp_path / "ledger")
    (drop / "one").mkdir(parents=True)
    (drop / "two").mkdir()
    write(drop / "one" / "same_td.csv", ["1,x", "2,y"])
    write(drop / "one" / "same_sf.csv", ["1,x", "2,y"])
    write(drop / "one" / "lonely_td.csv", ["1,x"])
    make_archive(drop / "two", "z.zip", {"diff_td.csv": "id,v\n1,x\n2,y\n", "diff_sf.csv": "id,v\n1,x\n2,z\n3,q\n"})
    summary, unpaired = validate_drop(spark, str(drop), out, ledger)
    found = {r["stem"]: (r["verdict"], r["mismatched_rows"], r["surplus_target_rows"]) for r in summary.collect()}
    assert found == {"same": ("MATCH", 0, 0), "diff": ("MISMATCH", 1, 1)}
    assert [(r["side"], r["name"]) for r in unpaired.collect()] == [("source", "lonely_td.csv")]
    written = spark.read.option("header", True).csv(out + "/*/differences")
    assert {r["diff_status"] for r in written.collect()} == {"mismatch", "only_target"}
    # A second run finds nothing new, until the missing half arrives.
    again, _ = validate_drop(spark, str(drop), out, ledger)
    assert again.isEmpty()
    write(drop / "one" / "lonely_sf.csv", ["1,x"])
    later, unpaired = validate_drop(spark, str(drop), out, ledger, parallel=2)
    assert [r["stem"] for r in later.collect()] == ["lonely"] and unpaired.isEmpty()


def test_many_pairs_in_parallel_redelivery_and_clashes(spark, tmp_path):
    drop, out, ledger = tmp_path / "drop", str(tmp_path / "out"), str(tmp_path / "ledger")
    for folder in ("a", "b"):
        (drop / folder).mkdir(parents=True)
        for i in range(8):
            write(drop / folder / f"p{i}_td.csv", ["1,x", f"2,{folder}"], "id,v" if folder == "a" else "id,w")
            write(drop / folder / f"p{i}_sf.csv", ["1,x", "2,a"], "id,v" if folder == "a" else "id,w")
    for archive in ("one.zip", "two.zip"):
        make_archive(drop / "a", archive, {"m_td.csv": "id\n1\n", "m_sf.csv": "id\n1\n"})
    summary, _ = validate_drop(spark, str(drop), out, ledger, parallel=8)
    found = {(r["folder"][-1], r["stem"]): (r["verdict"], r["mismatched_rows"]) for r in summary.collect()}
    assert found == {
        **{("a", f"p{i}"): ("MATCH", 0) for i in range(8)},
        **{("b", f"p{i}"): ("MISMATCH", 1) for i in range(8)},
        ("a", "m"): ("UNKNOWN", None),
    }
    assert spark.read.parquet(ledger).count() == 32
    written = spark.read.option("header", True).csv(out + "/*/differences")
    assert written.groupBy("diff_pair").count().count() == 8
    # Ragged rows and a redelivered pair of the same names.
    write(drop / "a" / "p3_td.csv", ["1,x", "2,a", "3,c"])
    write(drop / "a" / "p3_sf.csv", ["1,x", "2,a,EXTRA", "3,c"])
    again, _ = validate_drop(spark, str(drop), out, ledger, parallel=4)
    found = {r["stem"]: (r["verdict"], r["mismatched_rows"]) for r in again.collect()}
    assert found == {"p3": ("MISMATCH", 1), "m": ("UNKNOWN", None)}


def test_pairs_of_several_headers_are_written_at_the_same_time(spark, tmp_path):
    drop, out = tmp_path / "drop", str(tmp_path / "out")
    drop.mkdir()
    for number in range(5):
        header = "id," + ",".join(f"c{i}" for i in range(number + 1))
        for suffix, value in (("td", "x"), ("sf", "y")):
            rows = [f"{i},{value * (i % 2)}" + ",z" * number for i in range(300)]
            write(drop / f"r{number}_{suffix}.csv", rows, header)
    summary, _ = validate_drop(spark, str(drop), out, str(tmp_path / "ledger"), parallel=5)
    assert {(r["stem"], r["mismatched_rows"], r["error"]) for r in summary.collect()} == {(f"r{n}", 150, "") for n in range(5)}
    folders = list(pathlib.Path(out).glob("*/differences/diff_headers=*"))
    assert len(folders) == 5
    for folder in folders:
        rows = read_export(spark, str(folder))
        names = {r["diff_table"] for r in rows.select("diff_table").distinct().collect()}
        assert len(names) == 1 and rows.count() == 150
        assert {(r[0], r[1]) for r in rows.select("c0_source", "c0_target").distinct().collect()} == {("x", "y")}
        assert f"c{max(names)[1:]}_match" in rows.columns


def test_csv_cells_survive_a_round_trip(spark, tmp_path):
    texts = ['say "hi"', "back\\", 'both \\"', "two\nlines", " padded ", "a,b", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, v string")
    export_csv(frame, str(tmp_path / "e"), single_file=True)
    assert {int(r["id"]): r["v"] or "" for r in read_export(spark, str(tmp_path / "e")).collect()} == dict(enumerate(texts))
    reread = read_csv(spark, str(tmp_path / "e"), multi_line=True).collect()
    assert {int(r["id"]): r["v"].strip() for r in reread} == {i: t.strip() for i, t in enumerate(texts)}


def test_a_failing_pair_is_reported_and_tried_again(spark, tmp_path, monkeypatch):
    drop, out, ledger = tmp_path / "drop", str(tmp_path / "out"), str(tmp_path / "ledger")
    drop.mkdir()
    for name in ("bad_td.csv", "bad_sf.csv", "good_td.csv", "good_sf.csv"):
        write(drop / name, ["1,x"], "bad" if name.startswith("bad") else "good")

    def failing(source, target):
        if source.columns[0] == "bad":
            raise OSError("gone")
        return compare_positions(source, target)

    monkeypatch.setattr("twincheck.plans.drop.compare_positions", failing)
    first, _ = validate_drop(spark, str(drop), out, ledger)
    assert {r["stem"]: (r["verdict"], r["error"]) for r in first.collect()} == {
        "bad": ("UNKNOWN", "OSError: gone"),
        "good": ("MATCH", ""),
    }
    again, _ = validate_drop(spark, str(drop), out, ledger)
    assert [r["stem"] for r in again.collect()] == ["bad"]


def test_a_damaged_archive_is_reported_and_none_of_its_members_compared(spark, tmp_path):
    drop, out, ledger = tmp_path / "drop", str(tmp_path / "out"), str(tmp_path / "ledger")
    drop.mkdir()
    make_archive(drop, "good.zip", {"a_td.csv": "id\n1\n", "a_sf.csv": "id\n1\n"})
    with zipfile.ZipFile(drop / "bad.zip", "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("b_td.csv", "id\n1\n")
        archive.writestr("b_sf.csv", "id\n" + "7\n" * 1000)
    content = (drop / "bad.zip").read_bytes()
    (drop / "bad.zip").write_bytes(content.replace(b"7\n7\n7\n", b"7\n8\n7\n", 1))
    (drop / "worse.zip").write_bytes(b"no archive at all")
    summary, _ = validate_drop(spark, str(drop), out, ledger)
    found = {r["stem"]: (r["verdict"], r["error"].split(":")[0]) for r in summary.collect()}
    assert found == {"a": ("MATCH", ""), "bad.zip": ("UNKNOWN", "BadZipFile"), "worse.zip": ("UNKNOWN", "BadZipFile")}


def test_arrivals_are_reported_once(spark, tmp_path):
    drop, table, state = tmp_path / "drop", str(tmp_path / "arrivals"), str(tmp_path / "state")
    drop.mkdir()
    for name in ("a_td.csv", "a_sf.csv"):
        write(drop / name, ["1,x"])
        record_arrivals(spark, str(drop), table, state)
    record_arrivals(spark, str(drop), table, state)
    assert sorted(r["path"].rsplit("/", 1)[1] for r in spark.read.parquet(table).collect()) == ["a_sf.csv", "a_td.csv"]


def test_listing_reads_no_content(spark, tmp_path):
    write(tmp_path / "a_td.csv", ["1,x"])
    (tmp_path / "b.txt").write_text("")
    listed = list_files(spark, str(tmp_path), ".csv")
    assert listed.count() == 1
    plan = listed.select("path")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


class _Session:
    """Just the settings of a session."""

    def __init__(self, settings, master="local[2]"):
        self.master = master
        self.conf = settings
        self.sparkContext = self
        self.applicationId = "test"

    def getConf(self):
        return self.conf


def test_shared_folder_is_taken_from_the_session(spark):
    assert scratch_folder(_Session({"spark.checkpoint.dir": "hdfs://shared/ck/"}), "x").startswith("hdfs://shared/ck/x-")
    assert scratch_folder(_Session({}), "x").startswith("/tmp/run-")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            scratch_folder(_Session({}, master), "x")
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None


def test_scratch_folders_can_be_cleared(spark):
    folders = [scratch_folder(spark, f"s{i}") for i in range(3)]
    for folder in folders:
        spark.range(3).write.parquet(folder)
    assert clear_scratch(spark) >= 3 and clear_scratch(spark) == 0
    assert not any(os.path.exists(folder) for folder in folders)


def test_workers_import_the_package_from_any_folder(tmp_path):
    script = (
        "import sys, os; sys.path.insert(0, sys.argv[1]); import __spark_entry__ as e; from pyspark.sql import SparkSession;"
        "sys.path.remove(sys.argv[1]);"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate();"
        "print('rows', e.queries()['csv_ragged_rows'](spark, '/root/testdata/sf0.001').count())"
    )
    root = str(pathlib.Path(__file__).resolve().parent.parent)
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", script, root], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=240)
    assert "rows 1" in run.stdout, run.stderr[-2000:]
