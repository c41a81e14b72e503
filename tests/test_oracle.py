"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry_point
from workload.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, sf_dir, con, name):
    assert name in entry_point.oracle_sql(), "a registered query needs SQL"
    assert oracle.difference(entry_point.queries()[name](spark, sf_dir), con, entry_point.oracle_sql()[name]) is None


def test_entry_gives_the_class_counts(spark):
    counts = {row["status"]: row["row_count"] for row in entry_point.entry(spark).collect()}
    assert counts == {"match": 1408, "mismatch": 76, "only_source": 16, "only_target": 17}
