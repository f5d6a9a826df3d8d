import pytest
from oracle import differences
from siltworks.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, small, name):
    assert differences(spark, small, queries.QUERIES[name], queries.SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, small, name):
    """What SQL cannot say is tested elsewhere; here it must find something in the whole tables."""
    assert queries.QUERIES[name](spark, small).take(1), name
