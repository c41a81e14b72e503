"""How often a pair's tables are read."""

import pytest
from pyspark.sql import functions as F

from twincheck.operators.aggregates import aggregate_requests, compare_aggregates, profile_sides
from twincheck.operators.counts import compare_frequencies
from twincheck.plans.pair import plan_pair, validate_pair
from twincheck.plans.run import run_pair
from twincheck.sinks.exports import read_export
from twincheck.sources.config import PairSpec

ROWS = 500


@pytest.fixture
def counted(spark):
    """Two tables and how many times all rows of each were read so far."""
    seen = [spark.sparkContext.accumulator(0) for _ in range(2)]

    def watched(frame, total):
        def count(batches):
            for batch in batches:
                total.add(batch.num_rows)
                yield batch

        return frame.mapInArrow(count, frame.schema)

    source = spark.range(ROWS).selectExpr("id AS k", "id % 7 AS v", "cast(id AS double) / 3 AS d", "concat('t', id % 5) AS t")
    target = source.withColumn("v", F.expr("if(k % 100 = 3, -1, v)"))
    frames = watched(source, seen[0]), watched(target, seen[1])
    return frames, lambda: [total.value / ROWS for total in seen]


SPEC = PairSpec(
    "s.t", "d.t", keys=("K",), aggregate_columns=("V", "D", "V", "D", "T"), aggregate_functions=("SUM", "SUM", "COUNT", "AVG", "COUNT")
)


def test_all_checks_with_export_read_each_side_twice(counted, tmp_path):
    frames, reads = counted
    row = run_pair(SPEC, lambda spec: plan_pair(*frames, spec), str(tmp_path / "out"))
    assert (row["STATUS"], row["AGG_STATUS"], row["DATA_CONTENT_STATUS"], row["ERROR"]) == ("MISMATCH", "MISMATCH", "MISMATCH", "")
    assert reads() == [2, 2]


def test_a_summary_reads_each_side_twice(counted):
    frames, reads = counted
    assert validate_pair(*frames, SPEC).first()["AGG_STATUS"] == "MISMATCH"
    assert reads() == [2, 2]


def test_written_results_agree_with_the_operators(spark, counted, tmp_path):
    frames, _ = counted
    run_pair(SPEC, lambda spec: plan_pair(*frames, spec), str(tmp_path / "out"))
    written = {(r["COLUMN_NAME"], r["AGG_FUNCTION"]): r["MATCH_RESULT"] for r in read_export(spark, f"{tmp_path}/out/aggregates/d.t").collect()}
    assert written == {("V", "SUM"): "MISMATCH", ("D", "SUM"): "MATCH", ("D", "AVG"): "MATCH"}
    uneven = {(r["column_name"], r["value"]) for r in read_export(spark, f"{tmp_path}/out/frequencies/d.t").collect()}
    plain = compare_frequencies(*frames, ["v", "t"]).where("status <> 'match'").collect()
    assert uneven == {(r["column_name"].upper(), r["value"]) for r in plain} and ("V", "-1") in uneven
    sample = read_export(spark, f"{tmp_path}/out/samples/d.t").collect()
    assert [(r["diff_status"], r["sample_number"], r["K"]) for r in sample] == [("mismatch", str(i + 1), str(100 * i + 3)) for i in range(5)]


def test_a_saved_profile_gives_the_same_reports(spark):
    source = spark.sql("SELECT * FROM VALUES (1, 0.5D, 'a', DATE '2020-01-01'), (2, NULL, NULL, NULL), (2, 7D, 'a', NULL) t(i, d, s, w)")
    target = spark.sql("SELECT * FROM VALUES (1L, 0.5D, 'a', DATE '2020-01-01'), (2L, 7.5D, 'b', NULL) t(i, d, s, w)")
    requests = aggregate_requests(list("isdwdis"), ["COUNT", "COUNT", "SUM", "MAX", "AVG", "AVG", "MIN"])
    lazy = profile_sides(source, target, requests)
    saved = lazy.saved()
    for report in ("aggregates", "frequencies", "verdict"):
        assert sorted(map(repr, getattr(saved, report)().collect())) == sorted(map(repr, getattr(lazy, report)().collect()))
    frequencies = compare_frequencies(source, target, ["i", "s"])
    assert sorted(map(repr, saved.frequencies().collect())) == sorted(map(repr, frequencies.collect()))
    values = [r for r in requests if r.function != "COUNT"]
    assert sorted(map(repr, saved.aggregates().collect())) == sorted(map(repr, compare_aggregates(source, target, values).collect()))
    nothing = profile_sides(source, target, [])
    assert nothing.saved().verdict().first()["verdict"] == "UNKNOWN"
