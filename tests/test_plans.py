"""Shape of the physical plans: what is shuffled, pushed down and broadcast."""

import pytest

from twincheck.operators.aggregates import AggregateRequest, compare_aggregates
from twincheck.operators.compare import compare_rows
from workload import frames as w, row_queries, table_queries  # noqa: F401  (importing registers the queries)
from workload.registry import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark, sf_dir):
    return w.orders_pair(spark, sf_dir)


def test_classification_has_one_exchange_and_no_join(orders):
    shape = plan(compare_rows(*orders, w.ORDER_KEY).rows)
    assert shape.count("Exchange hashpartitioning") == 1
    assert "Join" not in shape


def test_tables_bucketed_on_the_key_are_not_shuffled(spark, orders, tmp_path):
    names = ["bucketed_source", "bucketed_target"]
    for side, name in zip(orders, names):
        writer = side.write.mode("overwrite").option("path", str(tmp_path / name))
        writer.bucketBy(4, "o_orderkey").sortBy("o_orderkey").saveAsTable(name)
    compared = compare_rows(*map(spark.table, names), w.ORDER_KEY)
    assert "Exchange" not in plan(compared.rows)
    expected = compare_rows(*orders, w.ORDER_KEY).class_counts().collect()
    assert sorted(compared.class_counts().collect()) == sorted(expected)
    for name in names:
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("report", ["counts", "verdict", "class_counts"])
def test_counts_move_keys_and_digests_only(orders, report):
    shape = plan(getattr(compare_rows(*orders, w.ORDER_KEY), report)())
    assert shape.count("Exchange hashpartitioning") == 1 and shape.count("Exchange SinglePartition") == 1
    assert "SortAggregate" not in shape and "Join" not in shape
    exchanged = shape.split("Exchange hashpartitioning")[1].split("\n")[1]
    assert "HashAggregate" in exchanged and "o_totalprice" not in exchanged


def test_column_metrics_agree_with_the_classified_rows(orders):
    compared = compare_rows(*orders, w.ORDER_KEY)
    expected = compared.rows.selectExpr(*compared.metric_expressions()).first().asDict()
    assert compared.metrics().first().asDict() == expected
    assert compared.key_metrics().first().asDict().items() <= expected.items()


def test_skipped_columns_are_not_read(orders):
    shape = plan(compare_rows(*orders, w.ORDER_KEY, skip=["o_totalprice", "o_orderdate"]).metrics())
    assert "o_totalprice" not in shape and "o_orderdate" not in shape


def test_all_aggregates_share_one_scan_per_side(orders):
    requests = [AggregateRequest("o_totalprice", f) for f in ("MIN", "MAX", "SUM", "AVG")]
    requests.append(AggregateRequest("o_custkey", "SUM"))
    source, _ = orders
    assert plan(compare_aggregates(source, source, requests)).count("FileScan") == 2


@pytest.mark.parametrize("size", [10, 2000])
def test_samples_are_limited_before_the_exchange(orders, size):
    shape = plan(compare_rows(*orders, w.ORDER_KEY).sample(size))
    assert shape.count(f"TakeOrderedAndProject(limit={size}") == 4


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_all_rows(spark, sf_dir, name):
    shape = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in shape and "BroadcastNestedLoopJoin" not in shape
