"""Pairing of files as they arrive, and fair sharing of concurrent pairs."""

import json
import os
import subprocess
import sys
from datetime import timedelta
from pathlib import Path

from twincheck.streaming.arrivals import pair_arrivals, record_pairs

DAY = 86_400
START = 1_700_000_000


def drop(folder, name, day):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("id\n1\n")
    os.utime(path, (START + day * DAY, START + day * DAY))


def test_files_are_paired_as_they_arrive(spark, tmp_path):
    folder, table, state = tmp_path / "drop", str(tmp_path / "pairs"), str(tmp_path / "state")

    def arrive(*files):
        for name, day in files:
            drop(folder, name, day)
        record_pairs(spark, str(folder), table, state, timedelta(days=2))
        rows = spark.read.parquet(table).collect()
        return sorted((r["stem"], r["status"], bool(r["source_path"]), bool(r["target_path"])) for r in rows)

    first = arrive(("x/a_td.csv", 0), ("x/a_sf.csv", 0), ("x/b_td.csv", 0), ("x/c_sf.csv", 0), ("x/e_td.csv", 0), ("notes.csv", 0))
    assert first == [("a", "pair", True, True)]
    second = arrive(("x/b_sf.csv", 1), ("y/c_td.csv", 1))
    assert second == [*first, ("b", "pair", True, True)]
    third = arrive(("x/e_sf.csv", 9), ("x/z_td.csv", 9))
    assert third == sorted(
        [*second, ("e", "late pair", True, True), ("c", "unpaired", False, True), ("c", "unpaired", True, False)]
    )
    # The counterpart of a half that was given up, and a name that begins anew; halves that still wait are not reported.
    fourth = arrive(("x/c_td.csv", 10), ("x/a2_td.csv", 10), ("x/a2_sf.csv", 10))
    assert fourth == sorted([*third, ("c", "late pair", True, True), ("a2", "pair", True, True)])
    assert arrive() == fourth


def test_pairs_of_other_suffixes(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES ('/d/a.left', TIMESTAMP '2024-01-01'), ('/d/a.right', TIMESTAMP '2024-01-02') t(path, modificationTime)")
    rows.write.parquet(str(tmp_path / "files"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "files"))
    pairs = pair_arrivals(stream, source_suffix=".left", target_suffix=".right")
    query = pairs.writeStream.format("memory").queryName("paired").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [tuple(r) for r in spark.table("paired").collect()] == [("/d", "a", "/d/a.left", "/d/a.right", "pair")]


def test_names_of_a_bucket_share_a_call_and_a_row_of_state(spark, tmp_path):
    days, names = (0, 1, 3), {}
    for i in range(300):
        names[f"n{i}"] = (days[i % 3] if i % 11 else None, days[i // 3 % 3] if i % 13 else None)
    came = [(f"/d/{n}{end}", day * DAY) for n, halves in names.items() for end, day in zip(("_td.csv", "_sf.csv"), halves) if day is not None]
    # A name that begins anew in the batch of its pair.
    came += [("/d/again_td.csv", 0), ("/d/again_sf.csv", 0), ("/d/again_td.csv", 60), ("/e/n1_td.csv", DAY)]
    files, pairs, state = (str(tmp_path / name) for name in ("files", "pairs", "state"))
    for day in days:
        rows = [(path, START + at) for path, at in came if at // DAY == day]
        table = spark.createDataFrame(rows, "path string, at long").selectExpr("path", "timestamp_seconds(at) AS modificationTime")
        table.write.mode("append").parquet(files)
        stream = pair_arrivals(spark.readStream.schema(table.schema).parquet(files), timedelta(hours=36), buckets=4)
        query = stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(pairs)
        query.awaitTermination()
        assert [progress.stateOperators[0].numRowsTotal <= 4 for progress in query.recentProgress] == [True] * len(query.recentProgress)
    expected = [("/d", "again", "pair"), ("/d", "again", "unpaired"), ("/e", "n1", "unpaired")]
    for name, (s, t) in names.items():
        if s is not None and t is not None:
            expected.append(("/d", name, "late pair" if abs(s - t) > 1.5 else "pair"))
        elif s != t and (t if s is None else s) < 3:
            expected.append(("/d", name, "unpaired"))
    assert sorted(tuple(r) for r in spark.read.parquet(pairs).select("folder", "stem", "status").collect()) == sorted(expected)


SCRIPT = """
import sys, time
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from twincheck.plans.parallel import run_each
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.scheduler.mode", "FAIR")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", {log!r}).config("spark.eventLog.compress", "false")
    .config("spark.eventLog.rolling.enabled", "false").getOrCreate())

def pause(rows):
    time.sleep(0.05)
    return rows

def pair(tasks):
    if tasks < 100:
        time.sleep(1.5)
    spark.sparkContext.parallelize(range(tasks), tasks).mapPartitions(pause).count()
    return tasks

run_each(spark, pair, [300, 4], parallel=2)
spark.stop()
"""


def test_a_small_pair_ends_while_a_large_one_runs(tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    script = SCRIPT.format(root=str(Path(__file__).resolve().parent.parent), log=log.as_uri())
    subprocess.run([sys.executable, "-c", script], check=True, timeout=240, capture_output=True)
    jobs, ends = {}, {}
    for file in (p for p in log.rglob("*") if p.is_file() and not p.name.endswith(".crc")):
        for line in file.read_text().splitlines():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                jobs[event["Job ID"]] = event["Properties"]["spark.scheduler.pool"]
            elif event["Event"] == "SparkListenerJobEnd":
                ends[jobs[event["Job ID"]]] = event["Completion Time"]
    assert ends.keys() == {"twincheck-0", "twincheck-1"} and ends["twincheck-1"] < ends["twincheck-0"]
