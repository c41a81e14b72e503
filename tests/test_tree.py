"""The digest tree, and column metrics from digests."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from test_compare import _SAMPLES
from pyspark.sql import functions as F

from twincheck.operators import prune
from twincheck.operators.compare import compare_rows, pair_columns, tag_sides
from twincheck.operators.prune import compare_pruned, unequal_leaves
from twincheck.plans.pair import content_comparison
from twincheck.sources.config import PairSpec
from workload import frames as w


def drifted(spark, rows, every):
    source = spark.range(rows).selectExpr("id AS k", "id % 1000 AS v", "repeat('x', 50) AS t")
    return source, source.withColumn("v", F.expr(f"if(k % {every} = 7, v + 1, v)"))


def differences(compared):
    return sorted(tuple(r) for r in compared.differences().select("k", "row_status").collect())


@pytest.mark.parametrize("buckets", [1, 16, 1 << 16])
def test_scattered_drift_moves_few_rows(spark, buckets):
    """One key in ten thousand differs: every node of the first level may, yet few rows are compared."""
    source, target = drifted(spark, 200_000, 10_000)
    pairing = pair_columns(source, target, ["k"])
    leaves, modulus = unequal_leaves(source, target, pairing, buckets, leaf_rows=50)
    moved = leaves.agg(F.sum("_size")).first()[0]
    assert moved < 0.05 * 400_000 and leaves.count() == 20 and modulus % buckets == 0
    compared = compare_pruned(source, target, ["k"], buckets=buckets, leaf_rows=50)
    assert differences(compared) == [(10_000 * i + 7, "mismatch") for i in range(20)]


def test_drifted_orders_of_the_tables(spark):
    """1 in 10^4 orders of sf0.1 with another price; the result is that of the plain comparison."""
    source, _ = w.orders_pair(spark, "/root/testdata/sf0.1")
    target = source.withColumn("o_totalprice", F.expr("o_totalprice + if(o_orderkey % 10007 = 3, 0.01, 0.00)"))
    pairing = pair_columns(source, target, w.ORDER_KEY)
    leaves, _ = unequal_leaves(source, target, pairing, 4, leaf_rows=100)
    assert leaves.agg(F.sum("_size")).first()[0] < 0.05 * 2 * source.count()
    pruned = compare_pruned(source, target, w.ORDER_KEY, buckets=4, leaf_rows=100).rows
    plain = compare_rows(source, target, w.ORDER_KEY).differences()
    assert pruned.exceptAll(plain).isEmpty() and plain.exceptAll(pruned).isEmpty()


def test_hot_keys_and_many_differences_end_the_descent(spark, monkeypatch):
    source = spark.range(20_000).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS v")
    target = source.withColumn("v", F.expr("if(v = 0, 1, v)"))
    levels = []
    whole = prune._node_totals
    monkeypatch.setattr(prune, "_node_totals", lambda *a: levels.append(a[3]) or whole(*a))
    compared = compare_pruned(source, target, ["k"], buckets=4, leaf_rows=10)
    assert differences(compared) == [(-1, "mismatch")] and len(levels) <= 4
    levels.clear()
    monkeypatch.setattr(prune, "MAX_BUCKETS", 1000)
    every = compare_pruned(*drifted(spark, 20_000, 1), ["k"], buckets=4, leaf_rows=10)
    assert every.differences().count() == 0 and len(levels) == 1
    many = compare_pruned(source, source.withColumn("v", F.expr("v + 1")), ["k"], buckets=4, leaf_rows=1)
    assert many.differences().count() == source.select("k").distinct().count()


def test_intact_copies_take_one_level(spark, monkeypatch):
    source, _ = drifted(spark, 5000, 7)
    levels = []
    whole = prune._node_totals
    monkeypatch.setattr(prune, "_node_totals", lambda *a: levels.append(a[3]) or whole(*a))
    assert compare_pruned(source, source, ["k"]).rows.isEmpty() and levels == [prune.DEFAULT_BUCKETS]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(data=st.data())
def test_column_metrics_agree_with_the_rows_for_all_types(spark, data):
    values = [data.draw(st.sampled_from(_SAMPLES)) for _ in range(4)]

    def side(a, b):
        return spark.sql(
            f"SELECT 1 AS k, {a} AS v, {b} AS w UNION ALL SELECT 2, NULL, {b} UNION ALL SELECT 3, {a}, NULL"
            f" UNION ALL SELECT 4, {a}, {b} UNION ALL SELECT 4, {a}, NULL UNION ALL SELECT 5, {a}, {b}"
        )

    compared = compare_rows(side(*values[:2]), side(*values[2:]).where("k <> 5"), ["k"])
    expected = compared.rows.selectExpr(*compared.metric_expressions()).first().asDict()
    assert compared.metrics().first().asDict() == expected


def test_one_scan_a_side_and_no_rows_fetched(spark, sf_dir):
    def executed(pair, keys):
        metrics = compare_rows(*pair, keys).metrics()
        metrics.collect()
        return metrics._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    # The changed side is a union of two scans of the table.
    assert executed(w.orders_pair(spark, sf_dir), w.ORDER_KEY).count("FileScan parquet") == 3
    # Repeated keys that differ read the same exchange, and then the rows of their buckets.
    plan = executed(w.repeated_pair(spark, sf_dir), w.LINE_KEY)
    assert "ReusedExchange" in plan


def test_five_hundred_columns(spark):
    columns = [f"id * {i} AS c{i}" for i in range(500)]
    source = spark.range(50).selectExpr("id AS k", *columns)
    target = source.withColumns({"c3": F.expr("if(k = 9, -1, c3)"), "c499": F.expr("if(k > 9, c499, NULL)")})
    rates = {r["column_name"]: r["mismatched"] for r in compare_rows(source, target, ["k"]).match_rates().collect()}
    assert len(rates) == 500 and rates.pop("c3") == 1 and rates.pop("c499") == 10 and set(rates.values()) == {0}


def test_keyless_metrics_compare_no_columns(spark):
    source = spark.range(100).selectExpr("id % 50 AS a", "id % 7 AS b")
    compared = content_comparison(source, source.where("a <> 3"), PairSpec("s", "t", "TABLE"))
    found = compared.metrics().first().asDict()
    assert found["_mismatched_0"] == 0 and found["only_source_keys"] == compared.key_metrics().first()["only_source_keys"] > 0
    assert "_m0" not in compared.metrics()._jdf.queryExecution().analyzed().toString()
