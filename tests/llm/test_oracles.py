"""The llm queries against their SQL, and the registration of all of them."""

import oracle
import pytest

import __spark_entry__ as entry_point
from twincheck.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, sf_dir, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), ORACLES[name]) is None


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_point.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in names
