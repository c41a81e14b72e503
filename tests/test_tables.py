"""Counts, aggregates, hashes, column helpers and checks around a migration."""

import datetime

import pytest
from pyspark.sql import types as T

from twincheck.functions.columns import drop_columns, impose_schema, lookup, trim_strings, upper_names
from twincheck.functions.comparability import Tolerance
from twincheck.functions.hashing import with_hash_key
from twincheck.operators.aggregates import (
    AggregateRequest,
    aggregate_requests,
    aggregate_verdict,
    compare_aggregates,
)
from twincheck.operators.audit import compare_queries, future_dates, successful_loads
from twincheck.operators.counts import (
    compare_frequencies,
    compare_row_counts,
    duplicate_keys,
    multiset_differences,
)
from twincheck.operators.hashkeys import with_shared_hash_key


def test_row_counts_read_no_column(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    compared = compare_row_counts(orders, orders.where("o_orderkey > 9"))
    assert tuple(compared.first()) == (1500, 1490, 10, "MISMATCH")
    plan = compare_row_counts(orders, orders)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_aggregate_requests():
    assert aggregate_requests(None, None) == []
    assert aggregate_requests(["a ", "b"], ["sum", " COUNT"], ["B"]) == [AggregateRequest("a", "SUM")]
    with pytest.raises(ValueError, match="2 aggregate columns but 1"):
        aggregate_requests(["a", "b"], ["SUM"])
    with pytest.raises(ValueError, match="MEDIAN"):
        aggregate_requests(["a"], ["MEDIAN"])


def test_aggregates_across_types(spark):
    source = spark.createDataFrame([(1, "b"), (2, "a"), (2, "a")], "n int, t string")
    target = spark.sql("SELECT cast(n AS decimal(10,2)) AS N, t AS T FROM VALUES (1, 'b'), (2, 'a'), (2, 'a') v(n, t)")
    requests = [AggregateRequest(c, f) for c, f in [("n", "SUM"), ("n", "MIN"), ("n", "AVG"), ("t", "MAX")]]
    rows = compare_aggregates(source, target, requests, source_name="S.T", source_filter="WHERE n > 0").collect()
    assert [r["MATCH_RESULT"] for r in rows] == ["MATCH"] * 4
    assert {r["SOURCE_QUERY"] for r in rows} >= {"SELECT SUM(n) FROM S.T WHERE n > 0"}


def test_text_that_looks_like_a_number_is_still_text(spark):
    source, target = spark.sql("SELECT '01' AS v"), spark.sql("SELECT '1' AS v")
    assert compare_aggregates(source, target, [AggregateRequest("v", "MIN")]).first()["MATCH_RESULT"] == "MISMATCH"


def test_sum_of_large_integers_does_not_overflow(spark):
    df = spark.sql(f"SELECT {2**62} AS v FROM range(8)")
    row = compare_aggregates(df, df, [AggregateRequest("v", "SUM")]).first()
    assert row["SOURCE_VALUE"] == str(2**65)


def test_float_sums_need_a_tolerance(spark):
    source = spark.createDataFrame([(0.1,), (0.2,)], "v double")
    target = spark.createDataFrame([(0.30000000000000009,), (0.0,)], "v double")
    request = [AggregateRequest("v", "SUM")]
    assert compare_aggregates(source, target, request).first()["MATCH_RESULT"] == "MISMATCH"
    loose = compare_aggregates(source, target, request, tolerance=Tolerance(relative=1e-9))
    assert loose.first()["MATCH_RESULT"] == "MATCH"


def test_aggregate_verdict(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, t string")
    requests = [AggregateRequest("n", "SUM"), AggregateRequest("t", "COUNT")]
    assert tuple(aggregate_verdict(df, df, requests).first()) == (2, 0, "MATCH")
    assert tuple(aggregate_verdict(df, df.where("n = 1"), requests).first()) == (2, 2, "MISMATCH")
    assert aggregate_verdict(df, df, []).first()["verdict"] == "UNKNOWN"


def test_frequencies_count_nulls_as_a_value(spark):
    source = spark.createDataFrame([("a",), (None,), (None,)], "v string")
    target = spark.createDataFrame([("a",), (None,), ("b",)], "v string")
    counted = compare_frequencies(source, target, ["V"])
    found = {r["value"]: (r["source_rows"], r["target_rows"], r["status"]) for r in counted.collect()}
    assert found == {"a": (1, 1, "match"), None: (2, 1, "mismatch"), "b": (0, 1, "only_target")}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in duplicate_keys(df, ["A", "b"]).collect()] == [(1, None, 2)]


HASH_ROWS = [("a", None, "b"), ("a", "b", None), ("a||b", None, None)]


def test_joined_hash_collides_and_safe_hash_does_not(spark):
    df = spark.createDataFrame(HASH_ROWS, "x string, y string, z string")
    assert with_hash_key(df).select("HASHED_UNIQUE_KEY").distinct().count() == 1
    assert with_hash_key(df, safe=True).select("HASHED_UNIQUE_KEY").distinct().count() == 3
    assert with_hash_key(df, ["Y", " z"]).select("HASHED_UNIQUE_KEY").distinct().count() == 2


def test_shared_hash_ignores_column_order_and_type(spark):
    source = spark.sql("SELECT 1 AS a, 'x' AS b, 2 AS skipped")
    target = spark.sql("SELECT 'x' AS B, cast(1 AS decimal(5,0)) AS A, 3 AS skipped")
    left, right = with_shared_hash_key(source, target, ["SKIPPED"])
    assert left.first()["HASHED_UNIQUE_KEY"] == right.first()["HASHED_UNIQUE_KEY"]


def test_multiset_differences_keep_multiplicity(spark):
    source = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    target = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    found = sorted((r["source_rows"], r["target_rows"]) for r in multiset_differences(source, target).collect())
    assert found == [(0, 1), (2, 1)]
    assert multiset_differences(source, source.repartition(3)).isEmpty()


def test_column_helpers(spark):
    df = spark.createDataFrame([(" a ", "\tb", 1)], "Ab string, c string, d int")
    assert upper_names(df).columns == ["AB", "C", "D"]
    assert tuple(trim_strings(df).first()) == ("a", "\tb", 1)
    assert drop_columns(df, [" AB", "nope"]).columns == ["c", "d"]
    with pytest.raises(ValueError, match="differ only in case"):
        upper_names(spark.createDataFrame([(1, 2)], "a int, b int").toDF("x", "X"))


def test_lookup(spark):
    df = spark.createDataFrame([(1, "it's", None), (2, "x", None)], "a int, b string, c int")
    assert lookup(df, {"B": "it's", "C": None}).first()["a"] == 1


def test_impose_schema(spark):
    df = spark.createDataFrame([("1", "x")], "B string, a string")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    assert impose_schema(df, schema).dtypes == [("a", "string"), ("b", "int")]
    numbers = T.StructType([T.StructField("a", T.IntegerType())])
    assert impose_schema(df, numbers, on_error="null").first()["a"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        impose_schema(df, numbers).collect()


def test_future_dates(spark):
    days = [None, "1000-01-01", "2020-01-01", "2030-01-01", "9999-12-31"]
    df = spark.createDataFrame([(d and datetime.date.fromisoformat(d),) for d in days], "d date")
    row = future_dates(df, "2025-01-01", lowest="1900-01-01", highest="2262-01-01").first()
    assert tuple(row) == ("d", 1, 1, 1, 2, "9999-12-31")
    with pytest.raises(ValueError):
        future_dates(spark.range(1), "2025-01-01")


def test_successful_loads(spark):
    audit = spark.createDataFrame(
        [("j1", "t1", "SUCCESS"), ("j1", "t2", "FAILED"), ("j2", "t3", "SUCCESS")],
        "job_name string, source_table_name string, status string",
    ).selectExpr("*", "'' AS start_time", "1 AS load_count", "'' AS load_type", "'' AS extract_query")
    inventory = spark.createDataFrame([("j1", "w"), ("j1", "w"), ("j2", "v")], "job_name string, wf_name string")
    assert [r["source_table_name"] for r in successful_loads(audit, inventory, "w").collect()] == ["t1"]


def test_compare_queries(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    compared = compare_queries(
        spark,
        "SELECT k, sum(v) AS s FROM {a} GROUP BY k",
        "SELECT k, max(v) AS s FROM {a} GROUP BY k",
        ["k"],
        tables={"a": df},
    )
    assert compared.verdict().first()["verdict"] == "MISMATCH"
