"""Sums of doubles that do not depend on the order of rows, and averages compared as fractions."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from twincheck.functions.comparability import Tolerance
from twincheck.functions.exactsum import PIECES, as_double, exact_total, pieces, with_pieces
from twincheck.operators.aggregates import aggregate_requests, compare_aggregates


def random_doubles(rng, n):
    return [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(n)]


def totals(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v double").selectExpr(f"inline(array({pieces('v')}))")
    rows = frame.where("class IS NOT NULL").groupBy("class").agg(*[F.sum(p) for p in PIECES])
    return exact_total(tuple(r) for r in rows.collect())


def test_the_sum_is_that_of_the_fractions(spark):
    rng = random.Random(1)
    values = [v for v in random_doubles(rng, 3000) if math.isfinite(v)]
    values += [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, 2.2250738585072014e-308, 0.1, -1e300]
    values += [math.ldexp(1 + d, 16 * k) for k in range(-66, 63) for d in (0, 2**-52, -(2**-53))]
    assert totals(spark, values) == sum(map(Fraction, values))
    assert totals(spark, [v for v in values if abs(v) < 1e-290]) == sum(Fraction(v) for v in values if abs(v) < 1e-290)


def test_what_has_no_finite_sum(spark):
    inf = float("inf")
    assert math.isnan(totals(spark, [1.0, float("nan")])) and math.isnan(totals(spark, [inf, -inf, 2.0]))
    assert totals(spark, [inf, 3.0]) == inf and totals(spark, [-inf, None]) == -inf
    assert totals(spark, [None]) == 0
    assert as_double(totals(spark, [1.7e308, 1.7e308])) == inf


def compared(source, target, columns, functions, **options):
    rows = compare_aggregates(source, target, aggregate_requests(columns, functions), **options).collect()
    return {(r["COLUMN_NAME"], r["AGG_FUNCTION"]): (r["SOURCE_VALUE"], r["TARGET_VALUE"], r["MATCH_RESULT"]) for r in rows}


def test_partitions_do_not_matter(spark):
    rng = random.Random(2)
    values = [rng.choice([1e16, 1.0, 0.1, -1e16, 3e-9]) * rng.random() for _ in range(5000)]
    source = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i long")
    columns, functions = ["v", "v", "v", "i", "i"], ["SUM", "AVG", "MAX", "SUM", "AVG"]
    first = compared(source, source.repartition(7), columns, functions)
    assert {v[2] for v in first.values()} == {"MATCH"} and all(v[0] == v[1] for v in first.values())
    exact = sum(map(Fraction, values))
    assert float(first["v", "SUM"][0]) == float(exact) and float(first["v", "AVG"][0]) == float(exact / 5000)
    assert float(first["v", "MAX"][0]) == max(values) and first["i", "SUM"][0] == str(5000 * 4999 // 2)
    # One value in its last bit, far below the last bit of the sum.
    moved = source.selectExpr("if(i = 17, v + 1e-13 * abs(v), v) AS v", "i")
    assert compared(source, moved, ["v"], ["SUM"])["v", "SUM"][2] == "MISMATCH"
    assert compared(source, moved, ["v"], ["SUM"], tolerance=Tolerance(relative=1e-9))["v", "SUM"][2] == "MATCH"


def test_floats_empty_and_mixed_columns(spark):
    source = spark.sql("SELECT * FROM VALUES (cast(0.5 AS float), 1, 'a'), (NULL, 2, 'b') t(f, i, s)")
    target = spark.sql("SELECT * FROM VALUES (0.5D, 1D, 'a'), (NULL, 2D, 'b') t(f, i, s)")
    found = compared(source, target, ["f", "i", "s", "i"], ["SUM", "AVG", "MAX", "MIN"])
    assert found["f", "SUM"] == ("0.5", "0.5", "MATCH") and found["i", "AVG"] == ("1.5", "1.5", "MATCH")
    assert found["s", "MAX"] == ("b", "b", "MATCH") and found["i", "MIN"][2] == "MATCH"
    empty = compared(source.where("false"), target.where("false"), ["f", "i", "s"], ["SUM", "AVG", "MIN"])
    assert set(empty.values()) == {(None, None, "MATCH")}
    assert compared(source, target.where("false"), ["f"], ["AVG"])["f", "AVG"] == ("0.5", None, "MISMATCH")


def test_averages_that_round_alike_differ(spark):
    source = spark.range(3).selectExpr("if(id = 0, 1, 0) AS v")
    target = spark.range(300_001).selectExpr("if(id < 100000, 1, 0) AS v")
    found = compared(source, target, ["v"], ["AVG"])["v", "AVG"]
    assert found[2] == "MISMATCH" and found[0][:6] == found[1][:6]
    twice = source.unionAll(source)
    assert compared(source, twice, ["v", "v"], ["AVG", "SUM"]) == {
        ("v", "AVG"): (found[0], found[0], "MATCH"), ("v", "SUM"): ("1", "2", "MISMATCH")
    }


@pytest.mark.parametrize("doubles", [1, 12])
def test_one_scan_for_all_requests(spark, doubles):
    frame = spark.range(10).selectExpr("id", *[f"cast(id AS double) AS d{i}" for i in range(doubles)])
    columns = ["id", *[f"d{i}" for i in range(doubles)], "d0"]
    plan = compare_aggregates(frame, frame, aggregate_requests(columns, ["MAX", *["SUM"] * doubles, "AVG"]))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Generate inline") >= 2


def test_pieces_of_a_table_are_those_of_the_expression(spark):
    rng = random.Random(3)
    values = [*random_doubles(rng, 2000), 0.0, -0.0, 5e-324, 1.7976931348623157e308, float("nan"), float("inf"), -float("inf"), None]
    frame = spark.createDataFrame(list(enumerate(values)), "i long, v double")
    first = frame.selectExpr("i", f"inline(array({pieces('v')}))").collect()
    assert sorted(first) == sorted(with_pieces(frame, "v").select("i", "class", *PIECES).collect())


@pytest.mark.parametrize("doubles", [1, 3, 12])
def test_the_code_of_a_sum_is_compiled(spark, doubles):
    """The JVM interprets methods of more than 8,000 bytes of code, which made a row cost some 40 microseconds."""
    frame = spark.range(10).selectExpr("id", *[f"id / 7D AS d{i}" for i in range(doubles)])
    requests = aggregate_requests(["id", *[f"d{i}" for i in range(doubles)]], ["AVG", *["SUM"] * doubles])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        plan = compare_aggregates(frame, frame, requests)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    found = getattr(getattr(debug, "package$"), "MODULE$").codegenStringSeq(plan)
    sizes = [found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())]
    assert sizes and max(sizes) < 8000


def test_columns_of_any_name(spark):
    frame = spark.sql("SELECT 0.5D AS _part, 1.5D AS class, 2.5D AS _number, 'a' AS _text, 3 AS a0")
    found = compared(frame, frame, ["_part", "class", "_number", "_text", "a0"], ["SUM", "SUM", "AVG", "MAX", "SUM"])
    assert [v[0] for _, v in sorted(found.items())] == ["2.5", "0.5", "a", "3", "1.5"] and {v[2] for v in found.values()} == {"MATCH"}
